"""All queries of the subpackage with their oracle SQL."""

from tillwork.llm import (  # noqa: F401
    byte_bpe,
    collocations,
    language_id,
    lexical_search,
    license_scan,
    order_minhash,
    packing,
    personal_data,
    sharding,
    simhash,
    substring_dedup,
    url_filter,
    vector_dedup,
)
from tillwork.llm.common import ORACLES, QUERIES  # noqa: F401
