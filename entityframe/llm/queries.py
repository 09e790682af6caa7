"""One query per operator over whole tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from entityframe.llm.compact_windows import op6_compact_windows
from entityframe.llm.decontaminate import op4_decontamination
from entityframe.llm.importance import op11_importance_resampling
from entityframe.llm.jaccard_join import op7_jaccard_join
from entityframe.llm.lattice_dedup import op10_lattice_dedup
from entityframe.llm.line_dedup import OP8_SQL, op8_line_dedup
from entityframe.llm.oracles import OP3_SQL, OP4_SQL, OP7_SQL
from entityframe.llm.packing import op5_packing
from entityframe.llm.pii import op9_pii
from entityframe.llm.quality import op2_quality
from entityframe.llm.suffix_dedup import op3_suffix_dedup
from entityframe.llm.url_filter import OP1_SQL, op1_url_filter
from entityframe.llm.vector_codes import OP12_SQL, op12_vector_codes
from entityframe.llm.vector_packing import op13_vector_packing

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_quality": op2_quality,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_compact_windows": op6_compact_windows,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_pii": op9_pii,
    "op10_lattice_dedup": op10_lattice_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_vector_codes": op12_vector_codes,
    "op13_vector_packing": op13_vector_packing,
}

ORACLES = {
    "op1_url_filter": OP1_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op4_decontamination": OP4_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
    "op12_vector_codes": OP12_SQL,
}
