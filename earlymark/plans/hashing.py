"""DuckDB SQL for Spark's xxhash64 on 64-bit arithmetic, as an oracle of its own."""

from __future__ import annotations

# Fixed values of the XXH64 algorithm.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
SEED, MODULUS = 42, 1 << 64


def _mod(x: str) -> str:
    return f"(({x}) % {MODULUS}::UHUGEINT)::UBIGINT"


def times(x: str, by: int) -> str:
    return _mod(f"({x})::UHUGEINT * {by}::UHUGEINT")


def plus(x: str, by: int) -> str:
    return _mod(f"({x})::UHUGEINT + {by}::UHUGEINT")


def rotated(x: str, by: int) -> str:
    return f"({times(x, 1 << by)} | ({x} >> {64 - by}))"


_END = [lambda h: f"xor({h}, {h} >> 33)", lambda h: times(h, P2), lambda h: f"xor({h}, {h} >> 29)", lambda h: times(h, P3), lambda h: f"xor({h}, {h} >> 32)"]


def _steps(source: str, steps: list) -> str:
    """source, whose column h is put through the steps one after the other."""
    for step in steps:
        source = f"(SELECT * REPLACE ({step('h')} AS h) FROM {source})"
    return source


def with_hash(source: str, columns: list[tuple[str, str]]) -> str:
    """source with h, the hash as an unsigned number, of (column, kind): long (not negative) or letter (a text of one ASCII character). Each column's hash seeds the next one's; a null leaves it as it is."""
    out = f"(SELECT *, {SEED}::UBIGINT AS h, 0::UBIGINT AS k, 0::UBIGINT AS before FROM {source})"
    for column, kind in columns:
        out = f"(SELECT * REPLACE (h AS before) FROM {out})"
        if kind == "long":
            out = f"(SELECT * REPLACE ({times(rotated(times(f'coalesce({column}, 0)::UBIGINT', P2), 31), P1)} AS k) FROM {out})"
            out = _steps(out, [lambda h: plus(h, P5 + 8), lambda h: f"xor({h}, k)", lambda h: rotated(h, 27), lambda h: plus(times(h, P1), P4), *_END])
        else:
            out = f"(SELECT * REPLACE ({times(f'''coalesce(ascii({column}), 0)::UBIGINT''', P5)} AS k) FROM {out})"
            out = _steps(out, [lambda h: plus(h, P5 + 1), lambda h: f"xor({h}, k)", lambda h: rotated(h, 11), lambda h: times(h, P1), *_END])
        out = f"(SELECT * REPLACE (CASE WHEN {column} IS NULL THEN before ELSE h END AS h) FROM {out})"
    return out


#: h as Spark's signed number.
SIGNED = f"(CASE WHEN h >= {MODULUS // 2}::UBIGINT THEN h::HUGEINT - {MODULUS}::HUGEINT ELSE h::HUGEINT END)"
