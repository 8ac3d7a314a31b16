"""Registered queries of this subpackage: the operators with production parameters over their whole tables."""

from __future__ import annotations

from orderloom.llm.bm25_packing import op5_bm25_packing
from orderloom.llm.byte_bpe import op10_byte_bpe
from orderloom.llm.chat_events import op9_chat_events
from orderloom.llm.crf_language import op6_crf_language
from orderloom.llm.cube_mixing import op12_cube_mixing
from orderloom.llm.fenwick_middle import ORACLE as FENWICK_MIDDLE, op13_fenwick_middle
from orderloom.llm.html_consensus import op2_html_consensus
from orderloom.llm.mcd_quality import op8_mcd_quality
from orderloom.llm.minimax_shards import op3_minimax_shards
from orderloom.llm.ngram_jaccard import op1_ngram_jaccard
from orderloom.llm.nn_descent import op4_nn_descent
from orderloom.llm.ppm_scoring import op7_ppm_scoring
from orderloom.llm.residue_negatives import ORACLE as RESIDUE_NEGATIVES, op11_residue_negatives

QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_html_consensus, op3_minimax_shards, op4_nn_descent, op5_bm25_packing, op6_crf_language,
    op7_ppm_scoring, op8_mcd_quality, op9_chat_events, op10_byte_bpe, op11_residue_negatives,
    op12_cube_mixing, op13_fenwick_middle)}

#: Digests of the reconstructed log are those of the given turns, which SQL can state. ``formatted_chars`` counts the
#: template: 6 + role + 2 before, 8 after a text, and one more for each escaped character.
_CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(16 + length(role) + length(text) + 2 * length(role || text)
                - length(replace(role || text, '\', '')) - length(replace(replace(role || text, '<', ''), '>', ''))) as bigint)
           as formatted_chars
from turns group by conv_id"""

ORACLES = {"op9_chat_events": _CHAT, "op11_residue_negatives": RESIDUE_NEGATIVES, "op13_fenwick_middle": FENWICK_MIDDLE}
