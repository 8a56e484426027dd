"""Registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from . import merkle, rules, shallot, substrings
from .bpe import op3_byte_bpe
from .fmindex import op6_decontamination
from .language import op10_language
from .lattice import op13_lattice
from .merkle import op11_manifest
from .near import op8_near_join
from .pii import op1_pii
from .quality import op5_quality
from .rules import op9_rules
from .secrets import op7_secrets
from .shallot import op12_centroids
from .substrings import op4_substrings
from .toxicity import op2_toxicity

QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_substrings": op4_substrings,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_secrets": op7_secrets,
    "op8_near_join": op8_near_join,
    "op9_rules": op9_rules,
    "op10_language": op10_language,
    "op11_manifest": op11_manifest,
    "op12_centroids": op12_centroids,
    "op13_lattice": op13_lattice,
}
ORACLES = {
    "op4_substrings": substrings.ORACLE,
    "op9_rules": rules.ORACLE,
    "op11_manifest": merkle.ORACLE,
    "op12_centroids": shallot.ORACLE,
}
