"""One module of queries per operator."""

from lathework.llm.queries import (
    decontamination, exact_dedup, fingerprints, html, language, near_duplicates, negatives, packing, pii, sharding, toxicity, warc, whitening,
)

FAMILIES = [packing, toxicity, pii, language, sharding, near_duplicates, decontamination, fingerprints, html, warc, exact_dedup, whitening, negatives]
