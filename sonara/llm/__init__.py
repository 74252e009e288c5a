"""Operations of a training-data pipeline: sharding, tokenising, deduplication, language
identification, quality rules, packing, page extraction, language-model scoring and
fingerprints. ``queries`` registers one query per operator."""
