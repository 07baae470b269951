"""A plain reader of the argument format, one value at a time, that the layout columns are compared with."""

from tidemark.functions.layouts import INT_SIZES


def read_value(kind, raw: bytes, at: int, keys: list[bytes]):
    """Read one value of a layout type at a byte position; returns it with the next position.

    Types: integer names, ``bool``, ``string``, ``bytes``, ``pubkey``, and one-entry dicts ``option``, ``vec``,
    ``array`` ([type, n]), ``struct`` ([[name, type], ...]) and ``enum`` ([[variant, fields or None], ...]).
    Integers of 64 bits and more become decimal text; public keys stay bytes and are also added to ``keys``.
    """
    if isinstance(kind, dict):
        (form, inner), = kind.items()
        if form == "option":
            present, at = read_value("u8", raw, at, keys)
            return read_value(inner, raw, at, keys) if present else (None, at)
        if form == "struct":
            fields = {}
            for name, field in inner:
                fields[name], at = read_value(field, raw, at, keys)
            return fields, at
        if form == "enum":
            which, at = read_value("u8", raw, at, keys)
            variant, fields = inner[which]
            value, at = read_value({"struct": fields or []}, raw, at, keys)
            return {variant: value}, at
        if form == "array":
            element, n = inner
        else:
            element = inner
            n, at = read_value("u32", raw, at, keys)
        items = []
        for _ in range(n):
            item, at = read_value(element, raw, at, keys)
            items.append(item)
        return items, at
    if kind == "bool":
        flag, at = read_value("u8", raw, at, keys)
        return bool(flag), at
    if kind in ("string", "bytes"):
        size, at = read_value("u32", raw, at, keys)
    else:
        size = 32 if kind == "pubkey" else INT_SIZES[kind]
    piece = raw[at:at + size]
    if len(piece) < size:
        raise ValueError("data ends early")
    at += size
    if kind == "string":
        return piece.decode("utf-8"), at
    if kind == "bytes":
        return list(piece), at
    if kind == "pubkey":
        keys.append(piece)
        return piece, at
    number = int.from_bytes(piece, "little", signed=kind[0] == "i")
    return (str(number) if size >= 8 else number), at
