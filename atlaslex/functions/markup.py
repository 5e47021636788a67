"""Wiki markup removal, inside one row.

Text survives only outside templates and tags. Whether a position is outside depends on two things: how many ``{{``
and ``<`` are still open (closers without an opener are ignored), and whether the last tag seen was an opening one. Both
change only at markers, so the text is cut into markers and plain runs, and a fold over these pieces decides per run.

A run of k equal braces holds k-1 overlapping pairs, hence moves the depth by k-1; braces are never printed. ``</`` and
``/>`` are pieces of their own because they end the tag state. The pieces are folded in blocks of ``BLOCK`` so
that the array built inside the fold stays short: the work is linear in the text for any article length, with no
shuffle and no sort.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atlaslex.functions import EMPTY_STRINGS, apply

BLOCK = 256
PIECE = r"\{+|\}+|</?|/?>|[^{}<>/]+|/"
# The heading that ends an article, and the characters that never reach the plain text.
SEE_ALSO = "==See also=="
DROPPED = "[]()'"


# One step of the fold: depth and tag state after a piece, and what the piece prints in the state before it.
_READ_PIECE = """
(state, piece) -> named_struct(
  'depth', CASE
    WHEN startswith(piece, '{') THEN state.depth + length(piece) - 1
    WHEN startswith(piece, '}') THEN greatest(state.depth - length(piece) + 1, 0)
    WHEN startswith(piece, '<') THEN state.depth + 1
    WHEN endswith(piece, '>') THEN greatest(state.depth - 1, 0)
    ELSE state.depth END,
  'in_tag', CASE WHEN piece = '<' THEN true WHEN piece IN ('</', '/>') THEN false ELSE state.in_tag END,
  'parts', concat(state.parts, array(CASE
    WHEN state.depth > 0 OR state.in_tag OR left(piece, 1) IN ('{', '}', '<', '>') THEN ''
    WHEN piece = '/>' THEN '/'
    ELSE piece END)))
"""
_OUTSIDE_ONLY = f"""
aggregate(
  regexp_extract_all(page, r'(?:{PIECE}){{1,{BLOCK}}}', 0),
  named_struct('depth', 0, 'in_tag', false, 'parts', {EMPTY_STRINGS}),
  (page_state, block) -> aggregate(
    regexp_extract_all(block, r'{PIECE}', 0),
    named_struct('depth', page_state.depth, 'in_tag', page_state.in_tag, 'parts', {EMPTY_STRINGS}),
    {_READ_PIECE},
    done -> named_struct('depth', done.depth, 'in_tag', done.in_tag,
                         'parts', concat(page_state.parts, array(array_join(done.parts, ''))))),
  done -> array_join(done.parts, ''))
"""
_PLAIN = f"CASE WHEN page RLIKE r'[{{}}<>]' THEN {_OUTSIDE_ONLY} ELSE page END"


def strip_markup(text: Column) -> Column:
    """Plain text of an article: templates, tags, brackets and everything from "See also" on are gone."""
    outside = apply(F.coalesce(text, F.lit("")), "page", _PLAIN)
    flat = F.translate(outside, "|" + DROPPED, " ")
    return F.translate(F.substring_index(flat, SEE_ALSO, 1), "=", " ")
