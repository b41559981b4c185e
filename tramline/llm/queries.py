"""Queries and oracle SQL of this subpackage, for ``__spark_entry__``."""

from __future__ import annotations

from .dart_minhash import op3_dart_minhash
from .decontam import op8_decontamination
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .html_text import op5_html_text
from .license_scan import op2_license
from .line_dedup import OP10_SQL, op10_line_dedup
from .merkle import OP13_SQL, op13_merkle
from .mixing import op4_mixing
from .repetition import op7_repetition
from .token_file import op11_token_file
from .toxicity import op9_toxicity
from .url_filter import OP6_SQL, op6_url_filter
from .warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_license": op2_license,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_mixing": op4_mixing,
    "op5_html_text": op5_html_text,
    "op6_url_filter": op6_url_filter,
    "op7_repetition": op7_repetition,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_file": op11_token_file,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = {
    "op1_warc": OP1_SQL,
    "op6_url_filter": OP6_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
