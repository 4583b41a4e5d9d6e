"""Regex matches with their places, in built-in SQL functions only.

Spark can list a pattern's matches (``regexp_extract_all``) and the text
between them (``split``), but not their positions; lengths of both give
them.  Positions count code points, ends are exclusive.  Patterns use
possessive repeats where Java's engine would recurse or go back, so a
very long text costs linear time and no stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches whose lengths are summed as one block: positions cost n²/512 steps, not n².
_BLOCK = 256
#: Code points of a chunk of a text that is cut at spans.
_CHUNK = 1024


def literal(pattern: str) -> str:
    """A raw SQL string literal for a pattern."""
    if '"' in pattern and "'" in pattern:
        pattern = pattern.replace("'", "\\x27")
    return f"r'{pattern}'" if "'" not in pattern else f'r"{pattern}"'


def cut(text: str, pattern: str, group: int = 0) -> Column:
    """struct(parts, found): text between matches (one more than matches) and the matches; with ``group`` also ``inner``."""
    p = literal(pattern)
    inner = f", 'inner', regexp_extract_all({text}, {p}, {group})" if group else ""
    return F.expr(f"named_struct('parts', split({text}, {p}, -1), 'found', regexp_extract_all({text}, {p}, 0){inner})")


def spans(cuts: str, kind: str, valid: str, rank: int = 0, shift: int = 0) -> Column:
    """array<struct<start, rank, end, kind, found>> of the matches that hold.

    ``valid`` is a SQL condition on ``m``, the match, and ``i``, its number.
    Only the places of valid matches are worked out.
    """
    lens = f"zip_with({cuts}.parts, {cuts}.found, (p, m) -> char_length(p) + coalesce(char_length(m), 0))"
    total = "aggregate({0}, 0, (a, x) -> a + x)"
    return F.expr(
        f"""
        case when size({cuts}.found) = 0 then cast(array() as array<struct<start: int, rank: int, end: int, kind: string, found: string>>)
        else element_at(transform(array({lens}), lens ->
          element_at(transform(array(transform(sequence(0, size(lens) div {_BLOCK}), b -> {total.format(f"slice(lens, 1, b * {_BLOCK})")})), blocks ->
            transform(
              transform(
                filter(transform({cuts}.found, (m, i) -> if({valid}, i, null)), i -> i is not null),
                i -> struct(i as i, blocks[i div {_BLOCK}] + {total.format(f"slice(lens, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK})")} + char_length({cuts}.parts[i]) - {shift} as start)),
              s -> struct(s.start as start, {rank} as rank, s.start + char_length({cuts}.found[s.i]) as end, '{kind}' as kind, {cuts}.found[s.i] as found))
          ), 1)), 1) end
        """
    )


def joined(array: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.expr(f"array_join(transform({array}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def replaced(cuts: str, valid: str, by: str) -> Column:
    """The text with its valid matches replaced by ``by``."""
    return F.expr(
        f"array_join(flatten(zip_with({cuts}.parts, transform({cuts}.found, (m, i) -> if({valid}, '{by}', m)), (p, m) -> array(p, coalesce(m, '')))), '')"
    )


def without(text: str, array: str) -> Column:
    """The text with the spans of ``array`` replaced by ``[KIND]``; spans that overlap are one, of the first's kind.

    The text is cut into chunks first, so a piece between spans costs its own length and not its place.
    """
    bind = "element_at(transform(array({0}), {1} -> {2}), 1)".format
    first = "({0}) div " + str(_CHUNK)
    in_one = f"substr(get(chunks, {first.format('{0}')}), ({{0}}) % {_CHUNK} + 1, ({{1}}) - ({{0}}))"
    over = (
        f"concat(substr(get(chunks, {first.format('{0}')}), ({{0}}) % {_CHUNK} + 1), "
        f"array_join(slice(chunks, {first.format('{0}')} + 2, {first.format('{1}')} - {first.format('{0}')} - 1), ''), "
        f"coalesce(substr(get(chunks, {first.format('{1}')}), 1, ({{1}}) % {_CHUNK}), ''))"
    )
    piece = f"coalesce(if({first.format('{0}')} = {first.format('{1}')}, {in_one}, {over}), '')".format
    reach = f"greatest(blocks[i div {_BLOCK}], coalesce(array_max(slice(ends, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK})), 0))"
    blocks = f"transform(sequence(0, size(ends) div {_BLOCK}), b -> coalesce(array_max(slice(ends, 1, b * {_BLOCK})), 0))"
    pieces = (
        f"transform(transform(ordered, (s, i) -> struct(s.start as start, s.kind as kind, {reach} as reach)), "
        f"x -> if(x.reach <= x.start, concat({piece('x.reach', 'x.start')}, '[', upper(x.kind), ']'), ''))"
    )
    whole = f"concat(array_join({pieces}, ''), {piece('array_max(ends)', f'char_length({text})')})"
    whole = bind(f"regexp_extract_all({text}, r'(?s).{{1,{_CHUNK}}}+', 0)", "chunks", whole)
    whole = bind("transform(ordered, s -> s.end)", "ends", bind(blocks, "blocks", whole))
    ordered = f"array_sort(transform({array}, (s, n) -> struct(s.start as start, n as n, s.end as end, s.kind as kind)))"
    return F.expr(f"case when size({array}) = 0 then {text} else {bind(ordered, 'ordered', whole)} end")
