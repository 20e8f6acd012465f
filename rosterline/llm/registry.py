"""Queries of this subpackage by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from rosterline.llm.decontam import op5_decontamination
from rosterline.llm.embedding import OP3_SQL, op3_embedding_dedup
from rosterline.llm.oracles import OP7_SQL, OP8_SQL, OP10_SQL
from rosterline.llm.packing import op9_packing
from rosterline.llm.pii import op7_pii
from rosterline.llm.quality import op2_quality
from rosterline.llm.repeats import op10_repeats
from rosterline.llm.sharding import op8_sharding
from rosterline.llm.simhash import op4_simhash
from rosterline.llm.tokencount import op6_token_counts
from rosterline.llm.warc import op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op6_token_counts": op6_token_counts,
    "op2_quality": op2_quality,
    "op5_decontamination": op5_decontamination,
    "op7_pii": op7_pii,
    "op10_repeats": op10_repeats,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_simhash": op4_simhash,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
}

ORACLES: dict[str, str] = {
    "op3_embedding_dedup": OP3_SQL,
    "op7_pii": OP7_SQL,
    "op8_sharding": OP8_SQL,
    "op10_repeats": OP10_SQL,
}
