"""SQL text for matches and their places in a text, and for scans of arrays, in time linear in the text.

Appending to an array inside ``aggregate`` copies it. A scan therefore works in blocks: results are appended to the
result of their block, and blocks to the whole, so a long array costs its length and not its square.
"""

from __future__ import annotations

BLOCK = 256


def quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and names it in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def scanned(items: str, start: str, step: str, when: str, emit: str, kind: str) -> str:
    """SQL for a scan of the array ``items`` from left to right.

    ``start`` is the first state; ``step`` (the next state), ``when`` (whether there is a result) and ``emit`` (the
    result, of SQL type ``kind``) see the state as ``a.state`` and the item as ``x``.
    """
    inner = f"""aggregate(slice(items, i, {BLOCK}), named_struct('state', b.state, 'out', cast(array() as array<{kind}>)),
      (a, x) -> named_struct('state', {step}, 'out', if({when}, concat(a.out, array({emit})), a.out)))"""
    block = let(inner, "done", "named_struct('state', done.state, 'outs', concat(b.outs, array(done.out)))")
    whole = f"""aggregate(sequence(1, greatest(size(items), 1), {BLOCK}),
      named_struct('state', {start}, 'outs', cast(array() as array<array<{kind}>>)), (b, i) -> {block}, b -> flatten(b.outs))"""
    return let(items, "items", whole)


def places(text: str, pattern: str, is_quoted: bool = True) -> str:
    """SQL for the matches of ``pattern`` (an expression if not ``is_quoted``) in the column or expression ``text`` as an
    array of (start, value)."""
    pattern = quoted(pattern) if is_quoted else pattern
    hit = f"regexp_extract_all({text}, {pattern}, 0)"
    zipped = f"zip_with(split({text}, {pattern}, -1), {hit}, (gap, hit) -> named_struct('gap', gap, 'hit', hit))"
    found = scanned(zipped, "0L", "a.state + length(x.gap) + coalesce(length(x.hit), 0)", "x.hit is not null",
                    "named_struct('start', a.state + length(x.gap), 'value', x.hit)", "struct<start: bigint, value: string>")
    return f"if({text} rlike {pattern}, {found}, array())"


PIECE = 1024


def pieces_of(text: str) -> str:
    """SQL that cuts a text into pieces of ``PIECE`` code points, for :func:`cut`."""
    return f"regexp_extract_all({text}, r'(?s).{{1,{PIECE}}}', 0)"


def cut(pieces: str, start: str, stop: str) -> str:
    """SQL for the code points from ``start`` to ``stop`` (exclusive) of the text that ``pieces`` were cut from.

    ``substring`` of a whole text reads it from its beginning; this reads the pieces it needs.
    """
    first = f"cast(({start}) div {PIECE} as int)"
    return f"""if(({stop}) <= ({start}), '', substring(array_join(slice({pieces}, {first} + 1,
      cast((({stop}) - 1) div {PIECE} as int) - {first} + 1), ''), cast(({start}) % {PIECE} as int) + 1, cast(({stop}) - ({start}) as int)))"""


RUN = "struct<start: bigint, is_run: int, stop: bigint, value: string>"


def apart(spans: str, runs: str) -> str:
    """SQL for the runs (start, stop, value), of which no two overlap, that overlap none of the spans (start, stop): one scan of
    both in order of their start."""
    items = f"""array_sort(concat(
      transform({spans}, s -> named_struct('start', s.start, 'is_run', 0, 'stop', s.stop, 'value', '')),
      transform({runs}, r -> named_struct('start', r.start, 'is_run', 1, 'stop', r.stop, 'value', r.value)),
      array(named_struct('start', {2 ** 62}L, 'is_run', 1, 'stop', {2 ** 62}L, 'value', ''))))"""
    # The state: the furthest end of a span so far, and the last run, which the next span may still meet.
    step = f"""if(x.is_run = 1,
        named_struct('top', a.state.top, 'held', if(a.state.top > x.start, cast(null as {RUN}), x)),
        named_struct('top', greatest(a.state.top, x.stop), 'held', if(x.start < a.state.held.stop, cast(null as {RUN}), a.state.held)))"""
    return scanned(items, f"named_struct('top', 0L, 'held', cast(null as {RUN}))", step,
                   "x.is_run = 1 and a.state.held is not null", "a.state.held", RUN)


def replaced(text: str, spans: str, by: str) -> str:
    """SQL for the text in which every span (start, stop, ...; in order) is replaced by the expression ``by`` over ``x``; of
    overlapping spans the first counts."""
    kind = "struct<after: bigint, start: bigint, stop: bigint, by: string>"
    chosen = scanned(spans, "0L", "if(x.start >= a.state, x.stop, a.state)", "x.start >= a.state",
                     f"named_struct('after', a.state, 'start', x.start, 'stop', x.stop, 'by', {by})", kind)
    joined = f"""concat(array_join(transform(c, s -> concat({cut('p', 's.after', 's.start')}, s.by)), ''),
      {cut('p', 'element_at(c, -1).stop', 'cast(length(t) as bigint)')})"""
    body = let(chosen, "c", f"if(size(c) = 0, t, {let(pieces_of('t'), 'p', joined)})")
    return let(text, "t", body)
