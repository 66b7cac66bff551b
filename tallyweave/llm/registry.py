"""Queries of the training-data operators for the entry module, and their SQL where SQL can express them."""

from __future__ import annotations

from tallyweave.llm.bytebpe import op1_bytebpe
from tallyweave.llm.decontam import op6_decontamination
from tallyweave.llm.license import op8_license
from tallyweave.llm.lm import op3_lm
from tallyweave.llm.simhash import op10_simhash
from tallyweave.llm.substring import OP7_SQL, op7_substring
from tallyweave.llm.topk import OP2_SQL, op2_topk
from tallyweave.llm.toxicity import op4_toxicity
from tallyweave.llm.urlfilter import OP5_SQL, op5_urlfilter
from tallyweave.llm.warc import OP9_SQL, op9_warc

QUERIES = {f.__name__: f for f in (op1_bytebpe, op2_topk, op3_lm, op4_toxicity, op5_urlfilter, op6_decontamination, op7_substring, op8_license, op9_warc, op10_simhash)}
ORACLES: dict[str, str] = {"op2_topk": OP2_SQL, "op5_urlfilter": OP5_SQL, "op7_substring": OP7_SQL, "op9_warc": OP9_SQL}
