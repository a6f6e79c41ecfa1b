"""Queries over the driver's tables, one for each operator, and their SQL."""

from __future__ import annotations

from factloom.llm.decontamination import op1_decontamination
from factloom.llm.divergence import OP13_SQL, op13_divergence
from factloom.llm.language import op2_language_id
from factloom.llm.merkle import OP12_SQL, op12_merkle
from factloom.llm.mixing import op8_mixing
from factloom.llm.partitions import op11_ann
from factloom.llm.records import op7_token_records
from factloom.llm.secrets import op10_secrets
from factloom.llm.simhash import op6_simhash
from factloom.llm.sites import OP3_SQL, op3_line_dedup
from factloom.llm.suffixes import op4_suffixes
from factloom.llm.vectors import OP5_SQL, op5_vectors
from factloom.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_suffixes": op4_suffixes,
    "op5_vectors": op5_vectors,
    "op6_simhash": op6_simhash,
    "op7_token_records": op7_token_records,
    "op8_mixing": op8_mixing,
    "op9_warc": op9_warc,
    "op10_secrets": op10_secrets,
    "op11_ann": op11_ann,
    "op12_merkle": op12_merkle,
    "op13_divergence": op13_divergence,
}
ORACLE: dict[str, str] = {
    "op3_line_dedup": OP3_SQL, "op5_vectors": OP5_SQL, "op9_warc": OP9_SQL, "op12_merkle": OP12_SQL, "op13_divergence": OP13_SQL,
}
