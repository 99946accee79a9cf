"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from curatio.llm.fingerprints import op9_fingerprints
from curatio.llm.language_model import op1_language_model
from curatio.llm.mixing import op2_mixing
from curatio.llm.near_duplicates import ORACLE as NEAR_DUPLICATES_SQL
from curatio.llm.near_duplicates import op6_near_duplicates
from curatio.llm.packing import op5_packing
from curatio.llm.pii import op4_pii
from curatio.llm.repeats import ORACLE as REPEATS_SQL
from curatio.llm.repeats import op7_repeats
from curatio.llm.token_counts import op3_token_counts
from curatio.llm.toxicity import op10_toxicity
from curatio.llm.vectors import ORACLE as VECTORS_SQL
from curatio.llm.vectors import op8_vectors

QUERIES = {f.__name__: f for f in (op1_language_model, op2_mixing, op3_token_counts, op4_pii, op5_packing, op6_near_duplicates, op7_repeats, op8_vectors, op9_fingerprints, op10_toxicity)}
#: The others have sampled sketches, trained weights, keyed draws or a tokenizer: they are tested against plain versions.
ORACLES = {"op6_near_duplicates": NEAR_DUPLICATES_SQL, "op7_repeats": REPEATS_SQL, "op8_vectors": VECTORS_SQL}
