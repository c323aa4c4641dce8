"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .bpe import op3_bpe
from .decontaminate import OP9_SQL, op9_decontaminate
from .katz import op8_katz
from .licenses import op10_licenses
from .pii import op4_pii
from .quality import op6_quality
from .secrets_scan import op7_secrets
from .simhash import op2_simhash
from .toxicity import op5_toxicity
from .token_binary import op1_token_binary

QUERIES = {f.__name__: f for f in (op1_token_binary, op2_simhash, op3_bpe, op4_pii, op5_toxicity, op6_quality, op7_secrets, op8_katz, op9_decontaminate, op10_licenses)}
ORACLE_SQL: dict[str, str] = {"op9_decontaminate": OP9_SQL}
