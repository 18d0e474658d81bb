"""The queries of this folder and the SQL they are checked against."""

from __future__ import annotations

from skyweave.llm.alignment import op11_alignment
from skyweave.llm.language_model import op3_language_model
from skyweave.llm.mixing import op2_mixing
from skyweave.llm.neighbours import op1_neighbours
from skyweave.llm.packing import op4_packing
from skyweave.llm.pii import op13_pii
from skyweave.llm.secrets import op7_secrets
from skyweave.llm.sharding import op9_sharding
from skyweave.llm.simhash import op8_simhash
from skyweave.llm.suffixes import op6_suffixes
from skyweave.llm.toxicity import op10_toxicity
from skyweave.llm.variants import op12_variants
from skyweave.llm.winnowing import op5_winnowing

QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_mixing": op2_mixing,
    "op3_language_model": op3_language_model,
    "op4_packing": op4_packing,
    "op5_winnowing": op5_winnowing,
    "op6_suffixes": op6_suffixes,
    "op7_secrets": op7_secrets,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_alignment": op11_alignment,
    "op12_variants": op12_variants,
    "op13_pii": op13_pii,
}

ORACLES: dict[str, str] = {}
