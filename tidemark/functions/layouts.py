"""Argument layouts compiled to SQL expressions over a BINARY column that give JSON text.

Parts of fixed size are slices at constant offsets; behind a part of variable size the offset runs along as a value.
Types: integer names, ``bool``, ``string``, ``bytes``, ``pubkey``, and one-entry dicts ``option``, ``vec``, ``array``
([type, n]), ``struct`` ([[name, type], ...]) and ``enum`` ([[variant, fields or None], ...]).  Integers of 64 bits and
more become quoted decimals.  Public keys stand as hex between two marks (``MARK``), which JSON text cannot hold, until
their base58 text is put in.  Data that ends early, texts that are not UTF-8 and unknown variants give NULL, and so does
a list that claims more elements than the data has bytes.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

INT_SIZES = {"u8": 1, "u16": 2, "u32": 4, "u64": 8, "u128": 16, "i8": 1, "i16": 2, "i32": 4, "i64": 8, "i128": 16}
MARK = "\x01"
_names = itertools.count()


def text(value: str) -> str:
    """A string literal of SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace(MARK, "\\u0001")
    return f"'{escaped}'"


def bind(value: str, use: Callable[[str], str]) -> str:
    """``use(name)`` with ``value`` computed once under that name, however often it is used."""
    name = f"v{next(_names)}"
    return f"get(transform(array({value}), {name} -> {use(name)}), 0)"


def layout_text(layout, raw: str, skip: int = 0) -> str:
    """JSON text of the value of type ``layout`` that starts ``skip`` bytes into ``raw``; NULL where it does not fit."""
    return f"({_read(layout, raw, f'{skip}L')}).text"


def fixed_size(kind) -> int | None:
    """Bytes of a value of this type, None if they depend on the data."""
    if isinstance(kind, str):
        return {**INT_SIZES, "bool": 1, "pubkey": 32}.get(kind)
    (form, inner), = kind.items()
    if form == "struct":
        sizes = [fixed_size(field) for _, field in inner]
        return None if None in sizes else sum(sizes)
    if form == "array":
        size = fixed_size(inner[0])
        return None if size is None else size * inner[1]
    return None


def _plus(at: str, n: int) -> str:
    if at.endswith("L") and at[:-1].isdigit():
        return f"{int(at[:-1]) + n}L"
    return f"({at} + {n})" if n else at


def _hex(raw: str, at: str, size: int) -> str:
    return f"hex(substring({raw}, cast({_plus(at, 1)} AS INT), {size}))"


def _fits(raw: str, end: str) -> str:
    return f"{end} <= length({raw})"


def _state(at: str, value: str) -> str:
    return f"named_struct('at', cast({at} AS BIGINT), 'text', cast({value} AS STRING))"


def _concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def _label(name: str) -> str:
    return json.dumps(name, ensure_ascii=False) + ":"


def _unsigned(raw: str, at: str, size: int) -> str:
    """Decimal text of up to eight little-endian bytes."""
    return f"conv({_concat(*[_hex(raw, _plus(at, i), 1) for i in reversed(range(size))])}, 16, 10)"


def _whole(value) -> str:
    return f"cast({value} AS DECIMAL(38, 0))"


def _wide(high: str, low: str) -> str:
    """Decimal text of ``high * 2**64 + low``, which may have 39 digits: the last nine are computed apart."""
    billion, step = f"{10**9}BD", _whole(f"'{2**64}'")

    def parts(rest: str) -> str:
        upper = _whole(f"({high} - {rest}) / {billion}")
        return bind(f"{rest} * {step} + {low}", lambda w: _concat(
            f"cast({upper} * {step} + {_whole(f'({w} - {w} % {billion}) / {billion}')} AS STRING)",
            f"lpad(cast(cast({w} % {billion} AS BIGINT) AS STRING), 9, '0')"))

    return f"regexp_replace({bind(_whole(f'{high} % {billion}'), parts)}, '^0+(?=[0-9])', '')"


def _integer(kind: str, raw: str, at: str) -> str:
    size, signed = INT_SIZES[kind], kind[0] == "i"
    if size < 16:
        plain = _unsigned(raw, at, size)
        if not signed:
            return plain
        return bind(f"cast({plain} AS DECIMAL(20, 0))", lambda n: (
            f"cast(CASE WHEN {n} >= {2 ** (8 * size - 1)}BD THEN {n} - {2 ** (8 * size)}BD ELSE {n} END AS STRING)"))
    halves = f"named_struct('high', {_whole(_unsigned(raw, _plus(at, 8), 8))}, 'low', {_whole(_unsigned(raw, at, 8))})"
    if not signed:
        return bind(halves, lambda n: _wide(f"{n}.high", f"{n}.low"))

    def with_sign(n: str) -> str:
        flipped = (f"named_struct('high', {_whole(f'{2**64 - 1}BD - {n}.high + if({n}.low = 0, 1, 0)')}, "
                   f"'low', if({n}.low = 0, {n}.low, {_whole(f'{2**64}BD - {n}.low')}))")
        negative = _concat("'-'", bind(flipped, lambda m: _wide(f"{m}.high", f"{m}.low")))
        return f"CASE WHEN {n}.high >= {2**63}BD THEN {negative} ELSE {_wide(f'{n}.high', f'{n}.low')} END"

    return bind(halves, with_sign)


def _fixed_text(kind, raw: str, at: str) -> str:
    """JSON text of a value of fixed size; the caller has checked that the data is long enough."""
    if kind == "bool":
        return f"if({_hex(raw, at, 1)} = '00', 'false', 'true')"
    if kind == "pubkey":
        return _concat(text('"' + MARK), _hex(raw, at, 32), text(MARK + '"'))
    if isinstance(kind, str):
        number = _integer(kind, raw, at)
        return _concat("'\"'", number, "'\"'") if INT_SIZES[kind] >= 8 else number
    (form, inner), = kind.items()
    if form == "array":
        return _list_of_fixed(inner[0], raw, at, f"{inner[1]}L")
    parts, offset = ["'{'"], 0
    for place, (name, field) in enumerate(inner):
        parts += [text(("," if place else "") + _label(name)), _fixed_text(field, raw, _plus(at, offset))]
        offset += fixed_size(field)
    return _concat(*parts, "'}'")


def _list_of_fixed(element, raw: str, at: str, n: str) -> str:
    name, size = f"v{next(_names)}", fixed_size(element)
    items = f"transform(sequence(0L, {n} - 1), {name} -> {_fixed_text(element, raw, f'({at} + {name} * {size})')})"
    return f"CASE WHEN {n} = 0 THEN '[]' ELSE {_concat("'['", f"array_join({items}, ',')", "']'")} END"


def _read(kind, raw: str, at: str) -> str:
    """``struct<at, text>``: the value's text and the offset behind it, both NULL where the data does not fit."""
    size = fixed_size(kind)
    if size is not None:
        end = _plus(at, size)
        fits = _fits(raw, end)
        return _state(f"if({fits}, {end}, NULL)", f"if({fits}, {_fixed_text(kind, raw, at)}, NULL)")
    if isinstance(kind, str):
        if kind not in ("string", "bytes"):
            raise ValueError(f"unknown layout type: {kind}")
        return _counted(raw, at, lambda start, n: _list("u8", raw, start, n) if kind == "bytes" else _string(raw, start, n))
    (form, inner), = kind.items()
    if form == "option":
        flag = _flag(raw, at)
        return (f"CASE WHEN {flag} = '00' THEN {_state(_plus(at, 1), "'null'")} "
                f"WHEN {flag} <> '00' THEN {_read(inner, raw, _plus(at, 1))} END")
    if form == "enum":
        cases = ""
        for i, (variant, fields) in enumerate(inner):
            value = bind(_read({"struct": fields or []}, raw, _plus(at, 1)), lambda r: _state(
                f"{r}.at", _concat(text("{" + _label(variant)), f"{r}.text", "'}'")))
            cases += f" WHEN '{i:02X}' THEN {value}"
        return f"CASE {_flag(raw, at)}{cases} END"
    if form == "array":
        return _list(inner[0], raw, at, f"{inner[1]}L")
    if form == "vec":
        return _counted(raw, at, lambda start, n: _list(inner, raw, start, n))
    if form != "struct":
        raise ValueError(f"unknown layout type: {form}")
    return _struct(inner, raw, at)


def _struct(fields, raw: str, at: str) -> str:
    """Fields of fixed size in one step, one step for each of variable size."""
    steps: list[list] = []
    for place, (name, field) in enumerate(fields):
        part = (text(("," if place else "{") + _label(name)), field)
        if steps and None not in (fixed_size(field), fixed_size(steps[-1][-1][1])):
            steps[-1].append(part)
        else:
            steps.append([part])
    state = None
    for step in steps:
        if state is None:
            state = _step(step, raw, at, None)
        else:
            state = bind(state, lambda s: _step(step, raw, f"{s}.at", f"{s}.text"))
    return bind(state, lambda s: _state(f"{s}.at", _concat(f"{s}.text", "'}'")))


def _step(step, raw: str, at: str, before: str | None) -> str:
    head = [before] if before else []
    (label, field), *_ = step
    if fixed_size(field) is None:
        return bind(_read(field, raw, at), lambda r: _state(f"{r}.at", _concat(*head, label, f"{r}.text")))
    parts, offset = head, 0
    for label, field in step:
        parts += [label, _fixed_text(field, raw, _plus(at, offset))]
        offset += fixed_size(field)
    fits = _fits(raw, _plus(at, offset))
    return _state(f"if({fits}, {_plus(at, offset)}, NULL)", f"if({fits}, {_concat(*parts)}, NULL)")


def _flag(raw: str, at: str) -> str:
    """A byte as two hex digits, NULL behind the end."""
    return f"if({_fits(raw, _plus(at, 1))}, {_hex(raw, at, 1)}, NULL)"


def _counted(raw: str, at: str, use: Callable[[str, str], str]) -> str:
    """``use(start, n)`` for what follows a 32-bit count."""
    count = f"if({_fits(raw, _plus(at, 4))}, cast({_unsigned(raw, at, 4)} AS BIGINT), NULL)"
    return bind(count, lambda n: f"if({n} IS NULL, NULL, {use(_plus(at, 4), n)})")


def _string(raw: str, start: str, n: str) -> str:
    fits = _fits(raw, f"{start} + {n}")
    piece = f"cast(substring({raw}, cast({_plus(start, 1)} AS INT), cast({n} AS INT)) AS STRING)"
    # to_json takes a list: the brackets around its one text are cut off.
    quoted = bind(f"if({fits}, {piece}, NULL)", lambda p: f"if(is_valid_utf8({p}), to_json(array({p})), NULL)")
    return _state(f"if({fits}, {start} + {n}, NULL)", bind(quoted, lambda q: f"substring({q}, 2, length({q}) - 2)"))


def _list(element, raw: str, start: str, n: str) -> str:
    """``n`` elements as a JSON list: slices if their size is fixed, else one after the other."""
    size = fixed_size(element)
    if size is not None:
        fits = f"{n} <= length({raw}) AND {_fits(raw, f'{start} + {n} * {size}')}"
        return _state(f"if({fits}, {start} + {n} * {size}, NULL)", f"if({fits}, {_list_of_fixed(element, raw, start, n)}, NULL)")
    state, place = f"v{next(_names)}", f"v{next(_names)}"
    added = bind(_read(element, raw, f"{state}.at"), lambda r: _state(
        f"{r}.at", _concat(f"{state}.text", f"if({place} > 1, ',', '')", f"{r}.text")))
    places = f"if({n} = 0, cast(array() AS ARRAY<BIGINT>), sequence(1L, {n}))"
    listed = f"aggregate({places}, {_state(start, "'['")}, ({state}, {place}) -> {added})"
    return bind(f"if({n} <= length({raw}), {listed}, NULL)", lambda s: _state(f"{s}.at", _concat(f"{s}.text", "']'")))
