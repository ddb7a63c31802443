"""The registered queries of this subpackage and their SQL."""

from plumbline.llm import op04_decontaminate, op10_sharding
from plumbline.llm.op01_mixing import op1_mixing
from plumbline.llm.op02_quality import op2_quality
from plumbline.llm.op03_minhash import op3_near_duplicates
from plumbline.llm.op04_decontaminate import op4_decontaminate
from plumbline.llm.op05_forest import op5_vectors
from plumbline.llm.op06_langid import op6_language
from plumbline.llm.op07_url import op7_url_filter
from plumbline.llm.op08_tokens import op8_token_ids
from plumbline.llm.op09_license import op9_licenses
from plumbline.llm.op10_sharding import op10_sharding as op10

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality": op2_quality,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_decontaminate": op4_decontaminate,
    "op5_vectors": op5_vectors,
    "op6_language": op6_language,
    "op7_url_filter": op7_url_filter,
    "op8_token_ids": op8_token_ids,
    "op9_licenses": op9_licenses,
    "op10_sharding": op10,
}

ORACLES = {"op4_decontaminate": op04_decontaminate.ORACLE, "op10_sharding": op10_sharding.ORACLE}
