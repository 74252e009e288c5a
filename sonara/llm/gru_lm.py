"""Language-model scores of documents: a gated recurrent network in numpy over Spark tables.

Counts. One job counts all training tokens (lower-cased words and one end per document).
The most frequent words (``LOOKUP_WORDS`` at most) are sent to all tasks; a document's other
words are joined with the whole count table, so every count is exact at any vocabulary.

Network. The most frequent words have ids of their own; their number and the state grow with the
measured vocabulary (``network_size``). All others share ``RARE`` ids by the hash of the word, so
every token reaches the network, as input and as what is predicted. A gated recurrent unit reads
the ids. The output is a tree: P(class | state) times P(slot | class, state); frequent words and shared
ids have a slot of their own, in another slot P(place | slot, state) tells its words apart. Each level has
about a cube root of the ids as choices, so a token's work grows with that root. Inside its rare id a word has its smoothed count share, so the probabilities of all words sum to one. Training is truncated back-propagation over
``STEPS``-token windows with the state carried on inside a document, up to a cut between lanes. In each of two rounds every task trains on
its own documents from the same start and the weights are averaged, block by block; the
first round takes an eighth of the documents, the second the others, so each is used once. There
are at most as many tasks as give each ``SHARE`` times the bytes of the weights to read, so the
weights sent stay below the ids read, however the network grows.

Scoring carries the state from a document's first token to its end.

Defined results: null text is empty (its only token is the end); a null doc_id is not learned
from; repeated rows are counted and scored each; very long texts are scored whole, window by window; an empty
table gives no rows; without training tokens the network is the untrained one
and all counts are 0; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import staged
from .token_counts import slices

END = " "  # no word has a space
LOOKUP_WORDS, MODEL_WORDS = 200_000, 512  # MODEL_WORDS: at least, see network_size
RARE = 256  # ids that the words without an id of their own share
STATE, STEPS, LANES = 8, 12, 1024  # STATE: at least
BRANCH, FIRST, TILE = 1.16, 128, 4  # of the tree: width per cube root of the ids, words before the shared ids, rows of the smallest batches
SCORE_LANES, SCORE_TOKENS = 2048, 1 << 14  # documents and tokens that are scored side by side
BLOCK = 1024  # rows of one softmax over classes and slots: its table stays in the cache
SHARE = 2  # bytes of ids that a training task reads, in sizes of the weights
WEIGHT_BLOCK = 1 << 16  # weights that are summed as one row
PIECE = 16  # rows of a run that are summed one after the other
SLICE = 1 << 22  # bytes of text that are split at once
RATE = 0.05
LARGEST = 5.0  # weights stay within this (or less, see limit), so no exponential overflows


def network_size(vocabulary: int) -> tuple[int, int]:
    """Model words and state for a measured vocabulary: 12 words per square root, 8 more of state per 16 times the words."""
    model = min(LOOKUP_WORDS, max(MODEL_WORDS, 12 * math.isqrt(vocabulary)))
    return model, STATE * max(1, round((model / MODEL_WORDS) ** 0.25))


def limit(state: int) -> float:
    """state + 1 products stay below 80, so their exponentials and the sums of these are finite in 32 bits."""
    return min(LARGEST, 80.0 / (state + 1))


# ---- the network --------------------------------------------------------------------------

def shape_of(ids: int) -> tuple[int, int, int, int]:
    """Classes (and slots of each), slots that hold an id, groups in the other slots, places of a group."""
    b = max(4, round(BRANCH * ids ** (1 / 3)))
    leaves = min(ids, b * b // 2)
    groups = max(1, min(b * b - leaves, ids - leaves))
    return b, leaves, groups, max(1, -(-(ids - leaves) // groups))


def codes(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, place in its group) of each id: frequent words and shared ids have slots of their own, other words a group's place."""
    ids = len(w["x"]) - 1
    _, leaves, _, size = shape_of(ids)
    words = max(0, ids - RARE)
    first = min(FIRST, words)
    order = np.concatenate([np.arange(1, first + 1), [0], np.arange(words + 1, ids), np.arange(first + 1, words + 1)])
    at = np.empty(ids, np.int64)
    at[order] = np.arange(ids)
    behind = np.maximum(at - leaves, 0)
    slot = np.where(at < leaves, at, leaves + behind // size)
    return slot.astype(np.uint16 if slot.max() < 1 << 16 else np.int64), behind % size  # 16 bits: sorted by radix


def start_weights(ids: int, state: int = STATE, seed: int = 5) -> dict[str, np.ndarray]:
    """``ids``: rare id 0, model words, other rare ids; where each lies in the tree: ``codes``."""
    r = np.random.default_rng(seed)
    b, leaves, groups, size = shape_of(ids)
    shapes = {"x": (ids + 1, 3 * state), "u": (state, 3 * state), "b": (3 * state,), "c": (state, b), "cb": (b,),
              "w": (b, state, b), "wb": (b, b), "v": (groups, state, size), "vb": (groups, size)}  # the last row of x: no token yet
    out = {k: (r.standard_normal(s) * 0.1).astype(np.float32) for k, s in shapes.items()}
    for k in ("b", "cb", "wb", "vb"):
        out[k][:] = 0
    slot, place = codes(out)
    for k, used in (("wb", slot), ("vb", ((slot.astype(np.int64) - leaves) * size + place)[slot >= leaves])):
        free = np.ones(out[k].size, bool)
        free[used] = False
        out[k].reshape(-1)[free] = -30  # slots and places that no word has
    free = np.bincount(slot // b, minlength=b) == 0
    out["cb"][free] = -30
    return out


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def shaped(v: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = v[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _gates(u, h, g):
    """One step, a lane per column, from inputs with biases ``g`` (overwritten): new state and what the backward pass needs."""
    n = len(h)
    hu = u @ h
    rz = g[:2 * n]
    rz += hu[:2 * n]
    rz *= 0.5
    np.tanh(rz, out=rz)
    rz *= 0.5
    rz += 0.5
    r, z, c, hn = rz[:n], rz[n:], g[2 * n:], hu[2 * n:]
    c += r * hn
    np.tanh(c, out=c)
    new = h - c
    new *= z
    new += c
    return new, (r, z, c, hn)


def gates(w, h, x):
    """One step, a lane per row: new state and what the backward pass needs."""
    new, kept = _gates(w["u"].T, h.T, (w["x"][x] + w["b"]).T.copy())
    return new.T, kept


def _summed(a: np.ndarray) -> np.ndarray:
    return np.ones(len(a), a.dtype) @ a


def _runs(k: np.ndarray, count: int) -> list[tuple[int, slice]]:
    """(value, rows) of the values below ``count`` in sorted ``k``, at most ``BLOCK`` rows at once."""
    cuts = np.searchsorted(k, np.arange(count + 1)).tolist()
    return [(c, slice(a, min(hi, a + BLOCK))) for c, (lo, hi) in enumerate(zip(cuts, cuts[1:])) for a in range(lo, hi, BLOCK)]


def _batches(group: np.ndarray, groups: int):
    """Rows sorted by group: groups of up to ``TILE`` rows, of up to twice as many, and so on; their rows, and which of these are theirs (others fill up)."""
    n = np.bincount(group, minlength=groups)
    first = np.cumsum(n) - n
    most, least = TILE, 0
    while least < n.max():
        alike, row = np.flatnonzero((n > least) & (n <= most)), np.arange(most)
        some = max(1, 2 * BLOCK // most)
        for lo in range(0, len(alike), some):
            of = alike[lo:lo + some]
            yield of, np.minimum(first[of, None] + row, len(group) - 1), row < n[of, None]
        most, least = 2 * most, most


def joined(w: dict[str, np.ndarray]) -> np.ndarray:
    """Of each class, the weights of the first two levels side by side with their biases as a last row, for states that end in a one."""
    b = len(w["cb"])
    return np.concatenate([np.concatenate([np.broadcast_to(w["c"], w["w"].shape), w["w"]], axis=2),
                           np.concatenate([np.broadcast_to(w["cb"], (b, b)), w["wb"]], axis=1)[:, None]], axis=1)


def _flat(a: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Where the place k of each row lies in the flat ``a``."""
    return np.arange(0, a.size, a.shape[1]) + k


def _picked(a: np.ndarray, k: np.ndarray) -> np.ndarray:
    """ln softmax of each row at its place k."""
    at = a.take(_flat(a, k))
    return at - np.log(np.exp(a, out=a) @ np.ones(a.shape[1], a.dtype))


def _errors(a: np.ndarray, k: np.ndarray, scale) -> np.ndarray:
    """``scale`` times the gradient of -ln softmax of each row at its place k."""
    np.exp(a, out=a)
    a *= (scale / (a @ np.ones(a.shape[1], a.dtype)))[:, None]
    a.reshape(-1)[_flat(a, k)] -= scale
    return a


def _both(c: int, k: np.ndarray) -> np.ndarray:
    """Of rows of class c with the place k in it, the places in their two rows of ``_errors`` or ``_picked``."""
    out = np.full(2 * len(k), c)
    out[1::2] = k
    return out


def log_probability(w, h, y, code=None, levels=None) -> np.ndarray:
    """ln P(y | h) of ids; for a shared id that of all its words. ``levels``: ``joined(w)``, then each state ends in a one."""
    b, leaves, groups, _ = shape_of(len(w["x"]) - 1)
    slots, places = code or codes(w)
    if levels is None:
        levels, h = joined(w), np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)
    slot = slots.take(y)
    order = np.argsort(slot, kind="stable")
    h, y, slot = h.take(order, axis=0), y.take(order), slot.take(order).astype(np.int64)
    k = slot // b
    slot_in = slot - k * b
    out = np.empty(len(y), h.dtype)
    for c, i in _runs(k, b):
        p = _picked((h[i] @ levels[c]).reshape(-1, b), _both(c, slot_in[i]))
        np.add(p[::2], p[1::2], out=out[i])
    deep = int(np.searchsorted(slot, leaves))
    if deep < len(y):
        h, place = h[deep:, :-1].copy(), places.take(y[deep:])
        for of, row, real in _batches(slot[deep:] - leaves, groups):
            a = h.take(row, axis=0) @ w["v"].take(of, axis=0)
            a += w["vb"].take(of, axis=0)[:, None]
            out[deep + row[real]] += _picked(a.reshape(row.size, -1), place.take(row.ravel()))[real.ravel()]
    back = np.empty_like(out)
    back[order] = out
    return back


class Trainer:
    """Truncated back-propagation with Adagrad over a window of tokens of many documents side by side."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = {k: v.copy() for k, v in w.items()}
        self.seen = {k: np.full(v.shape, 1e-3, np.float32) for k, v in w.items()}
        self.code = codes(w)
        self.tokens = 0

    def step(self, k: str, v: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Adagrad with the gradient ``v`` (overwritten) of the given rows of weights ``k``, or of all."""
        most = limit(self.w["u"].shape[0])
        least = -30 if k in ("cb", "wb", "vb") else -most
        some = max(1, (1 << 14) * len(v) // v.size)  # rows at a time: they stay in the cache
        for lo in range(0, len(v), some):
            d = v[lo:lo + some]
            if rows is None:
                w, seen = self.w[k][lo:lo + some], self.seen[k][lo:lo + some]
            else:
                at = rows[lo:lo + some]
                w, seen = self.w[k].take(at, axis=0), self.seen[k].take(at, axis=0)
            np.clip(d, -1, 1, out=d)
            root = d * d
            seen += root
            d *= RATE
            d /= np.sqrt(seen, out=root if root.dtype == seen.dtype else None)
            w -= d
            if k != "x":
                np.clip(w, least, most, out=w)
            if rows is not None:
                self.w[k][at], self.seen[k][at] = w, seen

    def output(self, a: np.ndarray, t: np.ndarray, scale) -> np.ndarray:
        """Trains the tree on states ``a`` (rows that end in a one) and the ids ``t`` that followed, -1 for none; the states' gradients."""
        w, (slots, places) = self.w, self.code
        b, leaves, groups, size = shape_of(len(w["x"]) - 1)
        n = a.shape[1] - 1
        here = np.flatnonzero(t >= 0)
        slot = slots.take(t if len(here) == len(t) else t.take(here))
        order = np.argsort(slot, kind="stable")
        slot = slot.take(order).astype(np.int64)
        if len(here) < len(t):
            order = here.take(order)
        a = a.take(order, axis=0)
        k = slot // b
        slot_in = slot - k * b
        levels = joined(w)
        g = np.zeros_like(levels)
        da = np.empty((len(a), n), a.dtype)
        for c, i in _runs(k, b):
            p = _errors((a[i] @ levels[c]).reshape(-1, b), _both(c, slot_in[i]), scale).reshape(-1, 2 * b)
            g[c] += a[i].T @ p
            np.matmul(p, levels[c, :n].T, out=da[i])
        deep = int(np.searchsorted(slot, leaves))
        if deep < len(a):
            states, place = a[deep:, :n].copy(), places.take(t.take(order[deep:]))
            parts, back, at = [], np.empty(len(states), np.int64), 0
            gv, gvb = np.zeros_like(w["v"]), np.zeros_like(w["vb"])
            for of, row, real in _batches(slot[deep:] - leaves, groups):
                tall, v = states.take(row, axis=0), w["v"].take(of, axis=0)
                q = tall @ v
                q += w["vb"].take(of, axis=0)[:, None]
                q = _errors(q.reshape(row.size, size), place.take(row.ravel()), scale)
                q = q.reshape(*row.shape, size)
                q[~real] = 0
                parts.append((q @ v.transpose(0, 2, 1)).reshape(row.size, n))
                back[row[real]] = at + np.flatnonzero(real)
                at += row.size
                gv[of] = tall.transpose(0, 2, 1) @ q
                gvb[of] = np.ones(row.shape[1], q.dtype) @ q
            da[deep:] += np.concatenate(parts).take(back, axis=0)
            used = np.unique(slot[deep:]) - leaves
            for name, v in (("v", gv), ("vb", gvb)):
                if 2 * len(used) < groups:
                    self.step(name, v.take(used, axis=0), used)
                else:  # without a gradient nothing moves
                    self.step(name, v)
        first = g[:, :, :b].sum(axis=0)
        for name, v in (("c", first[:n]), ("cb", first[n]), ("w", g[:, :n, b:]), ("wb", g[:, n, b:])):
            self.step(name, v)
        back = np.zeros(len(t), np.int64)
        back[order] = np.arange(len(order))
        out = da.take(back, axis=0)
        if len(here) < len(t):
            out[t < 0] = 0
        return out

    def window(self, h: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        """xs, ys: (steps, lanes), -1 where a lane has no token. The state after the window."""
        w, steps, (lanes, n) = self.w, len(xs), h.shape
        u, x = np.ascontiguousarray(w["u"].T), xs.ravel()
        g_in = w["x"].take(x, axis=0)
        g_in += w["b"]
        state, kept = np.ascontiguousarray(h.T), []
        hs = np.ones((steps * lanes, n + 1), state.dtype)
        inside = xs != len(w["x"]) - 1  # not a document's first token
        whole = inside.all(axis=1)
        for s in range(steps):
            i = slice(s * lanes, (s + 1) * lanes)
            before = state if whole[s] else state * inside[s]
            state, k = _gates(u, before, g_in[i].T.copy())
            hs[i, :n] = state.T
            kept.append((*k, before))
        y = ys.ravel()
        tokens = int(np.count_nonzero(y >= 0))
        scale = hs.dtype.type(32 / max(1, tokens))  # gradients of about 32 tokens
        dh_out = self.output(hs, y, scale) if tokens else np.zeros((len(y), n), hs.dtype)
        dh, dg, du = np.zeros_like(state), g_in, np.zeros_like(w["u"])  # the inputs' place takes their gradients
        d = np.empty((3 * n, lanes), dh.dtype)
        apart = np.empty((3 * n, lanes + 16), dh.dtype)[:, :lanes]  # its rows are no power of two apart, so a column's do not share a cache set
        dc, dz, dr = d[2 * n:], d[n:2 * n], d[:n]
        for s in range(steps - 1, -1, -1):
            i = slice(s * lanes, (s + 1) * lanes)
            dh += dh_out[i].T
            r, z, c, hn, before = kept[s]
            keep = 1 - z
            np.multiply(dh, keep, out=dc)
            dc *= 1 - c * c
            np.subtract(before, c, out=dz)
            dz *= dh
            dz *= z
            dz *= keep
            np.multiply(dc, hn, out=dr)
            dr *= r
            dr *= 1 - r
            apart[:] = d
            dg[i] = apart.T
            dc *= r
            du += before @ d.T
            dh *= z
            dh += w["u"] @ d
            if not whole[s]:
                dh *= inside[s]
        self.step("u", du)
        order = np.argsort(x, kind="stable")
        used, first = np.unique(x.take(order), return_index=True)
        by, sums = _gathered(dg, order, first)
        self.step("b", _summed(sums))
        self.step("x", sums, used.take(by))
        self.tokens += tokens
        return state.T

    def train(self, docs: list[np.ndarray], steps: int = STEPS, lanes: int = LANES) -> None:
        """All documents once: laid end to end over the lanes, the state cleared where one begins.

        A lane may begin inside a document; there, too, the state starts at zero."""
        start = len(self.w["x"]) - 1
        if not docs:
            return
        y = np.concatenate(docs)
        kind = np.uint16 if start < 1 << 16 else np.int32  # 16 bits: sorted by radix
        x = np.append(kind(start), y[:-1]).astype(kind)
        ends = np.cumsum([len(d) for d in docs])[:-1]
        x[ends[ends < len(x)]] = start
        lanes = max(1, min(lanes, len(y) // (4 * steps)))
        length = -(-len(y) // lanes)
        pad = lanes * length - len(y)
        y = np.ascontiguousarray(np.append(y.astype(np.int32), np.full(pad, -1, np.int32)).reshape(lanes, length).T)
        x = np.ascontiguousarray(np.append(x, np.full(pad, start, kind)).reshape(lanes, length).T)
        h = np.zeros((lanes, self.w["u"].shape[0]), np.float32)
        for a in range(0, length, steps):
            h = self.window(h, x[a:a + steps], y[a:a + steps])


def _gathered(d: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of the rows ``order``, long ones first, and their sums: all first rows, then second rows, and so on together; long runs by pieces."""
    sizes = np.diff(np.append(first, len(order)))
    if sizes.max() > PIECE:
        pieces = -(-sizes // PIECE)
        ends = np.cumsum(pieces)
        nth = np.arange(ends[-1]) - np.repeat(ends - pieces, pieces)
        by, sums = _gathered(d, order, np.repeat(first, pieces) + PIECE * nth)
        return _gathered(sums, np.argsort(by), ends - pieces)
    by = np.argsort(-sizes, kind="stable")
    first = first.take(by)
    out = d.take(order.take(first), axis=0)
    more = np.searchsorted(-sizes.take(by), -np.arange(PIECE)).tolist()  # runs of more than so many rows: a prefix
    for n in range(1, PIECE):
        if more[n]:
            out[:more[n]] += d.take(order.take(first[:more[n]] + n), axis=0)
    return by, out


def score_documents(w: dict[str, np.ndarray], docs: list[np.ndarray], tokens: int = SCORE_TOKENS) -> np.ndarray:
    """ln P of each document's ids; the state is carried from window to window.

    Side by side are ``SCORE_LANES`` documents of about one length; a window ends with the step that brings it to ``tokens``."""
    start, n, kind = len(w["x"]) - 1, w["u"].shape[0], w["u"].dtype
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    out = np.zeros(len(docs))
    half = np.repeat(np.array([0.5, 1], kind), [2 * n, n])  # sigmoid(2 x) = (1 + tanh(x)) / 2
    u, inputs = np.ascontiguousarray(w["u"].T) * half[:, None], (w["x"] + w["b"]) * half
    code, levels = codes(w), joined(w)
    for lo in range(0, len(docs), SCORE_LANES):
        order = by_length[lo:lo + SCORE_LANES]
        sizes = lengths[order]
        all_ids = np.concatenate([docs[i] for i in order])
        first = np.cumsum(sizes) - sizes
        h, x = np.zeros((n, len(order)), kind), np.full(len(order), start)
        hs, ys, rows, held = np.ones((tokens + len(order), n + 1), kind), [], [], 0
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]))).tolist()  # documents longer than s: a prefix
        for s, live in enumerate(alive):
            if live < len(x):
                h, x = h[:, :live].copy(), x[:live]
            g, hu = inputs.take(x, axis=0).T.copy(), u @ h
            rz, c = g[:2 * n], g[2 * n:]
            rz += hu[:2 * n]
            np.tanh(rz, out=rz)
            rz *= 0.5
            rz += 0.5
            hu[2 * n:] *= rz[:n]
            c += hu[2 * n:]
            np.tanh(c, out=c)
            h -= c
            h *= rz[n:]
            h += c
            x = all_ids.take(first[:live] + s)
            hs[held:held + live, :n] = h.T
            ys.append(x)
            rows.append(order[:live])
            held += live
            if held >= tokens or s + 1 == len(alive):
                lp = log_probability(w, hs[:held], np.concatenate(ys), code, levels)
                out += np.bincount(np.concatenate(rows), weights=lp, minlength=len(docs))
                ys, rows, held = [], [], 0
    return out


# ---- the Spark jobs -----------------------------------------------------------------------

def learned(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 != 2, F.lit(False))


def _words(text: bytes | None) -> list[bytes]:
    """Words of a text and its end, as ``_coded`` finds those of many texts. On bytes lower() takes A-Z only, split() space and \\x09-\\x0D only."""
    out = (text or b"").lower().split()
    out.append(END.encode())
    return out


def _coded(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The ``_words`` of all texts end to end as numbers, the words that these stand for, and where each text ends."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    kept = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)  # bytes are taken as they are
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(kept)))
    split = lists.flatten().dictionary_encode()
    codes, sizes = split.indices.to_numpy(), pc.list_value_length(lists).to_numpy()
    words = split.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    if b"" in words:  # of a text without words
        some = codes != words.index(b"")
        first = np.cumsum(sizes) - sizes
        sizes = sizes - ~some[first]
        codes = codes[some]
    ends = np.cumsum(sizes + 1, dtype=np.int64)
    out = np.empty(len(codes) + len(ends), np.int32)
    word = np.ones(len(out), bool)
    word[ends - 1] = False
    out[word], out[ends - 1] = codes, len(words)
    return out, [*words, END.encode()], ends


def text_slices(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts that end with the one that brings them to ``SLICE`` bytes: what is held at once does not follow the batch."""
    upto = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(upto):
        hi = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SLICE)) + 1
        yield slice(lo, min(hi, len(upto)))
        lo = hi


def token_totals(docs: DataFrame) -> DataFrame:
    """(token, c) of all training documents."""

    def run(batches):
        from collections import defaultdict

        seen: dict[bytes, int] = defaultdict(int)
        for b in batches:
            texts = b.column(0)
            for s in text_slices(texts):
                codes, words, _ = _coded(texts[s])
                for word, n in zip(words, np.bincount(codes, minlength=len(words)).tolist()):
                    if n:
                        seen[word] += n
                if len(seen) > 300_000:
                    yield pa.RecordBatch.from_arrays([strings(list(seen)), pa.array(seen.values(), pa.int64())], names=["token", "n"])
                    seen.clear()
        yield pa.RecordBatch.from_arrays([strings(list(seen)), pa.array(seen.values(), pa.int64())], names=["token", "n"])

    rows = docs.where(learned(F.col("doc_id"))).select(F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("c"))


def strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def most_frequent(totals: DataFrame, top: int) -> list[tuple[str, int]]:
    """At most ``top`` words, most frequent first: all whose count lies above a level that fits."""
    levels = {r["level"]: r["words"] for r in totals.groupBy(F.floor(F.log2("c") * 8).cast("int").alias("level"))
              .agg(F.count(F.lit(1)).alias("words")).collect()}
    cut, room = max(levels, default=0) + 1, top
    for level in sorted(levels, reverse=True):
        room -= levels[level]
        if room < 0:
            break
        cut = level
    got = totals.where(F.floor(F.log2("c") * 8) >= cut).select("token", "c").collect()
    return sorted(((r["token"], r["c"]) for r in got), key=lambda x: (-x[1], x[0]))


def rare_id(word: str, model_words: int) -> int:
    """0, or an id behind those of the model words; the same hash as ``rare_totals``."""
    k = zlib.crc32(word.encode("utf-8", "surrogatepass")) % RARE
    return model_words + k if k else 0


def rare_totals(totals: DataFrame, model: list[tuple[str, int]]) -> np.ndarray:
    """Of each id, log10 of what its words' smoothed counts and one more sum to; 0 where a word has the id to itself."""
    out = np.zeros(len(model) + RARE)
    sums = np.ones(RARE)
    for r in totals.groupBy((F.crc32(F.col("token").cast("binary")) % RARE).alias("k")).agg(F.sum(F.col("c") + 1).alias("n")).collect():
        sums[r["k"]] += r["n"]
    for t, c in model:
        sums[zlib.crc32(t.encode("utf-8", "surrogatepass")) % RARE] -= c + 1
    out[0], out[len(model) + 1:] = math.log10(sums[0]), np.log10(sums[1:])
    return out


def encode(docs: DataFrame, known: list[tuple[str, int]], model: list[str]) -> DataFrame:
    """row, doc_id, n_tokens, n_known, logs, rare_logs, ids and the words that ``known`` lacks with their numbers.

    logs sums log10(c + 1) of the known tokens, rare_logs those of them whose id is shared."""
    number = {t: i + 1 for i, t in enumerate(model)}
    log = np.append(np.log10(np.array([c for _, c in known]) + 1.0), 0.0)  # last: a word to be looked up
    ids_of = np.array([number.get(t) or rare_id(t, len(model)) for t, _ in known] + [0], dtype=id_type(len(model)))
    rare_log = np.where(np.array([t in number for t, _ in known] + [False]), 0.0, log)
    none, model_words = len(known), len(model)
    sent = docs.sparkSession.sparkContext.broadcast(([t.encode("utf-8", "surrogatepass") for t, _ in known], ids_of, log, rare_log))

    def run(batches):
        from itertools import repeat

        words, ids_of, log, rare_log = sent.value
        place = {t: i for i, t in enumerate(words)}.get
        part, row = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = b.column(1)
            for s in text_slices(texts):
                codes, words, ends = _coded(texts[s])
                where = np.fromiter(map(place, words, repeat(none)), np.int64, len(words))
                ids = ids_of.take(where)
                asked = np.flatnonzero(where == none)
                missing = [words[i] for i in asked.tolist()]
                shared = np.fromiter(map(zlib.crc32, missing), np.int64, len(missing)) % RARE
                ids[asked] = np.where(shared > 0, shared + model_words, 0)  # as rare_id
                first, ids = np.append(0, ends[:-1]), ids.take(codes)
                at = where.take(codes)
                n = len(ends)
                # the words to be looked up, once for each text and word
                lacks = np.flatnonzero(at == none)
                nth = np.zeros(len(words), np.int64)
                nth[asked] = np.arange(len(asked))
                pairs, times = np.unique(np.searchsorted(ends, lacks, "right") * max(1, len(asked)) + nth.take(codes.take(lacks)), return_counts=True)
                doc, word = np.divmod(pairs, max(1, len(asked)))
                cuts = np.searchsorted(doc, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part << 40) + row + np.arange(n)), b.column(0).slice(s.start, n), pa.array(ends - first),
                     pa.array(np.add.reduceat(at < none, first, dtype=np.int64)), pa.array(np.add.reduceat(log.take(at), first)),
                     pa.array(np.add.reduceat(rare_log.take(at), first)),
                     pa.array([ids[i:e].tobytes() for i, e in zip(first.tolist(), ends.tolist())], pa.binary()),
                     pa.MapArray.from_arrays(pa.array(cuts, pa.int32()), strings(missing).take(pa.array(word)), pa.array(times, pa.int64()))],
                    names=["row", "doc_id", "n_tokens", "n_known", "logs", "rare_logs", "ids", "words"])
                row += n

    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, n_known long, logs double, rare_logs double, "
                                "ids binary, words map<string,long>")


def id_type(model_words: int) -> type:
    return np.uint16 if model_words + RARE <= 1 << 16 else np.int32


def _ids(column, model_words: int) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=id_type(model_words)) for x in column]


def training_tasks(id_bytes: int, weight_bytes: int) -> int:
    """Tasks of a round: each reads at least ``SHARE`` times the bytes of the weights that it sends."""
    return max(1, id_bytes // (SHARE * weight_bytes))


def train(coded: DataFrame, words: int, state: int = STATE) -> dict[str, np.ndarray]:
    """Weights after both rounds. Tasks send theirs in blocks that are summed by number; the driver
    gets one averaged vector, the size of the network."""
    sc = coded.sparkSession.sparkContext
    weights = start_weights(words + RARE, state)
    early = F.pmod(F.xxhash64(F.lit(11), "row"), F.lit(8)) == 0
    used = coded.where(learned(F.col("doc_id")))
    bytes_of = {r["early"]: r["n"] for r in used.groupBy(early.alias("early")).agg(F.sum(F.octet_length("ids")).alias("n")).collect()}
    for first, part in ((True, early), (False, ~early)):
        if not bytes_of.get(first):
            continue
        sent = sc.broadcast(weights)

        def run(batches, sent=sent):
            trainer = Trainer(sent.value)
            for b in batches:
                docs = _ids(b.column(0), words)
                for s in slices(docs, 1 << 21):
                    trainer.train(docs[s])
            if trainer.tokens:
                w = flat(trainer.w)
                for k, lo in enumerate(range(0, len(w), WEIGHT_BLOCK)):
                    yield pa.RecordBatch.from_pydict({"block": pa.array([k]), "n": pa.array([trainer.tokens], pa.int64()),
                                                      "w": pa.array([w[lo:lo + WEIGHT_BLOCK].tobytes()], pa.binary())})

        def weighted(r):
            return r["block"], (r["n"], np.frombuffer(r["w"], np.float32) * np.float32(r["n"]))

        def add(a, b):
            return a[0] + b[0], a[1] + b[1]

        tasks = training_tasks(bytes_of[first], 4 * len(flat(weights)))
        rows = used.where(part).select("ids").coalesce(tasks).mapInArrow(run, "block long, n long, w binary")
        blocks = -(-len(flat(weights)) // WEIGHT_BLOCK)
        sums = rows.rdd.map(weighted).reduceByKey(add, min(blocks, tasks)).collect()
        weights = shaped(np.concatenate([w / n for _, (n, w) in sorted(sums, key=lambda x: x[0])]), weights)
    return weights


def score(docs: DataFrame, lookup_words: int = LOOKUP_WORDS, model_words: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``model_words``: as many as ``network_size`` says where None."""
    sc = docs.sparkSession.sparkContext
    totals = staged(token_totals(docs), "totals")
    size = totals.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(size["n"]), int(size["v"])
    known = most_frequent(totals, lookup_words)
    most, state = network_size(v)
    model = known[:most if model_words is None else model_words]
    coded = staged(encode(docs, known, [t for t, _ in model]), "coded")
    weights = sc.broadcast(train(coded, len(model), state))
    shared = sc.broadcast(rare_totals(totals, model))
    n_model = len(model)

    # the words that were not sent: joined with the whole count table, then summed per row
    asked = coded.select("row", F.explode("words").alias("token", "times"))
    found = (asked.join(totals, "token").groupBy("row")
             .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_logs")))

    def run(batches):
        w = weights.value
        for b in batches:
            ids = _ids(b.column(6), n_model)
            lp: list[float] = []
            for s in slices(ids, 1 << 22):
                lp += (score_documents(w, ids[s]) / math.log(10)).tolist()
            rare = [float(shared.value[x].sum()) for x in ids]
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(lp, pa.float64()), pa.array(rare, pa.float64())],
                                             names=["row", "doc_id", "n_tokens", "n_known", "logs", "rare_logs", "net", "rare_sums"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    scored = coded.select("row", "doc_id", "n_tokens", "n_known", "logs", "rare_logs", "ids").mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, n_known long, logs double, rare_logs double, net double, rare_sums double")
    more = F.coalesce("more_logs", F.lit(0.0))
    return (scored.join(found, "row", "left")
            .select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"), "n_tokens",
                    (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("logs") + more - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
                    (F.col("net") + F.col("rare_logs") + more - F.col("rare_sums")).alias("score")))
