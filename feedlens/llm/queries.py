"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import urlfilter
from .bpe import op3_bpe
from .conversation import op13_conversation
from .decontaminate import op7_decontaminate
from .merkle import op12_merkle
from .pii import op2_pii
from .prefixbpe import op11_prefixbpe
from .quality import op6_quality
from .secrets import op10_secrets
from .sharding import op9_sharding
from .simhash import op1_simhash
from .spotsigs import op5_fingerprints
from .substring import op8_substring
from .urlfilter import op4_urlfilter

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_bpe": op3_bpe,
    "op4_urlfilter": op4_urlfilter,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_substring": op8_substring,
    "op9_sharding": op9_sharding,
    "op10_secrets": op10_secrets,
    "op11_prefixbpe": op11_prefixbpe,
    "op12_merkle": op12_merkle,
    "op13_conversation": op13_conversation,
}

ORACLE_SQL: dict[str, str] = {"op4_urlfilter": urlfilter.oracle()}
