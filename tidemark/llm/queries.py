"""One query for each corpus operator, with SQL where it can express it."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm.boilerplate import ORACLE as LINE_DEDUP
from tidemark.llm.boilerplate import op6_line_dedup
from tidemark.llm.conversations import op13_conversation_repair
from tidemark.llm.decontaminate import op4_decontaminate
from tidemark.llm.hard_negatives import ORACLE as HARD_NEGATIVES
from tidemark.llm.hard_negatives import op11_hard_negatives
from tidemark.llm.language import op2_language
from tidemark.llm.near_dup import op8_near_dup
from tidemark.llm.nearest import ORACLE as TOP_PRODUCTS
from tidemark.llm.nearest import op7_top_products
from tidemark.llm.packing import op3_pack
from tidemark.llm.quality import op9_quality
from tidemark.llm.repeats import op10_repeats
from tidemark.llm.token_files import op1_token_files
from tidemark.llm.toxicity import op5_toxicity
from tidemark.llm.warc import ORACLE as WARC
from tidemark.llm.warc import op12_warc

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_language": op2_language,
    "op3_pack": op3_pack,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_top_products": op7_top_products,
    "op8_near_dup": op8_near_dup,
    "op9_quality": op9_quality,
    "op10_repeats": op10_repeats,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_warc": op12_warc,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op6_line_dedup": LINE_DEDUP,
    "op7_top_products": TOP_PRODUCTS,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_warc": WARC,
}
