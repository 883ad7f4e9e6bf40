"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from .bpe import op6_bpe
from .centroid_clustering import OP11_SQL, op11_centroid_clustering
from .decontaminate import op7_decontaminate
from .fill_in_middle import OP12_SQL, op12_fill_in_middle
from .html_extract import op10_html_extract
from .minhash import OP13_SQL, op13_minhash
from .quality_classifier import op9_quality_classifier
from .quality_rules import op5_quality_rules
from .secrets import op1_secrets
from .simhash import op2_simhash
from .token_counts import op3_token_counts
from .toxicity import op8_toxicity
from .warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_simhash": op2_simhash,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe": op6_bpe,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_html_extract": op10_html_extract,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_minhash": op13_minhash,
}

ORACLE: dict[str, str] = {
    "op4_warc": OP4_SQL,
    "op11_centroid_clustering": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_minhash": OP13_SQL,
}
