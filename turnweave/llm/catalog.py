"""The queries of this package and their SQL."""

from __future__ import annotations

from .exact_dedup import OP9_SQL, op9_exact_dedup
from .html_text import op8_html_text
from .language_id import op3_language_id
from .licenses import op2_license_scan
from .mixing import op1_mix_sources
from .near_dedup import op6_minhash_near_dedup
from .neighbours import op7_additive_quantisation
from .packing import op10_best_fit_packing
from .paragraphs import op5_paragraph_dedup
from .secrets import op13_secret_scan
from .target_resampling import OP12_SQL, op12_target_resampling
from .toxicity import op4_toxicity
from .vector_codes import OP11_SQL, op11_vector_codes

QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_license_scan, op3_language_id, op4_toxicity, op5_paragraph_dedup,
        op6_minhash_near_dedup, op7_additive_quantisation, op8_html_text, op9_exact_dedup, op10_best_fit_packing,
        op11_vector_codes, op12_target_resampling, op13_secret_scan,
    )
}
SQL = {"op9_exact_dedup": OP9_SQL, "op11_vector_codes": OP11_SQL, "op12_target_resampling": OP12_SQL}
