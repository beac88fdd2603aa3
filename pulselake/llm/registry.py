"""Queries of the training-data operators, by name, and oracle SQL where SQL can express one."""

from __future__ import annotations

from .bpe import op1_bpe
from .line_dedup import op2_line_dedup
from .cotraining import op4_cotraining
from .imatch import op6_imatch
from .minhash import op8_minhash
from .multi_index import op5_multi_index
from .packing import op10_packing
from .suffix_dedup import op7_suffix_dedup
from .toxicity import op9_toxicity
from .warc import OP3_SQL, op3_warc

QUERIES = {f.__name__: f for f in (op1_bpe, op2_line_dedup, op3_warc, op4_cotraining, op5_multi_index, op6_imatch, op7_suffix_dedup, op8_minhash, op9_toxicity, op10_packing)}
ORACLES: dict[str, str] = {"op3_warc": OP3_SQL}
