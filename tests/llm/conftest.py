import random
import tempfile

import pytest
from embedding_rows import vectors

TEXT_A = " ".join(f"the{i % 7} quick of brown{i} fox and jumped over a lazy dog{i}" for i in range(12))
TEXT_B = TEXT_A.replace("brown5", "green5")
TEXT_C = "Der die das und ein Haus ist nicht mit den Leuten von zu auf für eine Stadt. " * 2


def _words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.3 else
                    "".join(rng.choice("abcdeorst") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, lang): nulls, empty and long texts, ties, repeated rows, odd characters."""
    rng = random.Random(3)
    long_text = _words(rng, 30_000)
    rows = [(1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (4, TEXT_A, "en"), (5, TEXT_A, "en"), (6, TEXT_B, "en"),
            (6, TEXT_B, "en"), (7, TEXT_C, "de"), (8, "one", "en"), (9, "two words", None), (10, "123 456 !!", "en"),
            (11, "<|endoftext|> x <|startoftext|>y", "en"), (12, "naïve ΣΑΣ İstanbul 日本語 😀 é   end", "fr"),
            (13, long_text, "en"), (14, long_text + " tail", "en"), (15, "same line\n" * 40, "en"), (None, TEXT_C, "de"),
            (None, None, None), (16, "a" * 5000, "en"), (17, "### $$$ %%% " * 30, "en")]
    rows += [(20 + i, _words(rng, rng.randint(30, 200)), "en") for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def edge_dir(spark, edge_rows):
    """The rows with columns whose names clash with those of the operators, and pages."""
    out = tempfile.mkdtemp(prefix="sonara-llm-")
    rows = [(*r, f"s{i}", i, i, "x", float(i), i, "h") for i, r in enumerate(edge_rows)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, "
                                "score double, row long, host string").repartition(3).write.parquet(f"{out}/documents.parquet")
    page = "<html><body><nav>menu {0}</nav><div class='cookie'>we use cookies</div><article><h1>T{0}</h1><p>a &amp; b{0}<p>c<b>d</b> < e" \
           "<form>f</form><div class=comments>said</div></article><aside>x</aside><footer>foot</footer><script>var a='<p>';</script>"
    pages = [(i, f"http://h{i % 2}.org/{i}", page.format(i), "z") for i in range(8)]
    pages += [(8, None, page.format(8), "z"), (9, "http://h0.org/9", None, "z"), (10, "http://h0.org/10", "", "z"),
              (0, "http://h0.org/0", page.format(0), "z"), (None, "x", "plain 1 < 2 text", "z"),
              (11, "http://h3.org/1", "<body><nav>m</nav>" + "<p>w w</p>" * 3000, "z")]
    spark.createDataFrame(pages, "page_id long, url string, html string, template string").write.parquet(f"{out}/pages.parquet")
    spark.createDataFrame([(*v, 1, "row", [0.5]) for v in vectors()], "vec_id long, label int, embedding array<float>, row long, slot string, "
                          "code array<double>").repartition(3).write.parquet(f"{out}/embeddings.parquet")
    return out


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir):
    out = tempfile.mkdtemp(prefix="sonara-llm-empty-")
    for t in ("documents", "embeddings", "pages"):
        spark.read.parquet(f"{edge_dir}/{t}.parquet").limit(0).write.parquet(f"{out}/{t}.parquet")
    return out
