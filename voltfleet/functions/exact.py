"""Exact sums of doubles in SQL: the same result in any order, rounded once.

A double is cut into limbs, whole numbers of 2 ** 32, 1, 2 ** -32, 2 ** -64 and 2 ** -96. Limbs are
added up as BIGINT, so partial sums, retries and other partitionings cannot change them, and
running sums can be subtracted from each other without an error. ``total`` joins them to the
nearest double. Nothing is lost of values of 2 ** -43 (1e-13) and more; smaller ones keep what lies
at or above 2 ** -96. A sum that holds a value of 2 ** 64 or more, or one that is not finite, is null.

BIGINT sums hold 2 ** 31 values, far beyond a vehicle's day; ``wide`` ones, for whole tables of
records, are added up as DECIMAL first.
"""

from __future__ import annotations

PLACES = (-96, -64, -32, 0, 32)
RADIX = 2**32
REACH = 2.0**64  # of values; of those that are squared, the root of it
TOP = len(PLACES) - 1
#: Splits a double into two halves of 26 bits, whose products are exact.
_SPLITTER = "134217729D"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _within(value: str, reach: float = REACH) -> str:
    return f"CASE WHEN abs({value}) < {reach!r}D THEN {value} END"


def _limb(value: str, k: int) -> str:
    rest = value if k == TOP else f"({value} % {2.0 ** (PLACES[k] + 32)!r}D)"
    return f"CAST({rest} * {2.0 ** -PLACES[k]!r}D AS BIGINT)"


def limbs(value: str, reach: float = REACH) -> str:
    """The limbs of one double as an array, and 1 behind them if it is out of reach."""
    kept = _within(value, reach)
    own = [f"coalesce({_limb('v', k)}, 0L)" for k in range(TOP + 1)]
    return let("v", kept, f"array({', '.join(own)}, CAST(v IS NULL AND {value} IS NOT NULL AS BIGINT))")


def _sums(parts: list[str], wild: str, over: str, wide: bool) -> str:
    if not wide:
        return f"array({', '.join(f'coalesce(sum({p}) {over}, 0L)' for p in parts)}, coalesce(sum({wild}) {over}, 0L))"
    # Every limb hands what is above its place on to the next one, and all are BIGINT again.
    added = [f"coalesce(sum(CAST({p} AS DECIMAL(20, 0))) {over}, 0BD)" for p in parts]
    carry = lambda k: f"(s.l{k} div {RADIX}BD)"
    own = []
    for k in range(TOP + 1):
        rest = f"CAST(s.l{k} - CAST({carry(k)} AS DECIMAL(38, 0)) * {RADIX}BD AS BIGINT)" if k < TOP else f"CAST(s.l{k} AS BIGINT)"
        own.append(rest + (f" + {carry(k - 1)}" if k else ""))
    held = ", ".join(f"'l{k}', CAST({a} AS DECIMAL(38, 0))" for k, a in enumerate(added))
    body = f"array({', '.join(own)}, s.wild)"
    return let("s", f"named_struct({held}, 'wild', coalesce(sum({wild}) {over}, 0L))", body)


def limb_sums(value: str, over: str = "", wide: bool = False, times: str = "1L") -> str:
    """Sums of the limbs, as an aggregate or over a window; all 0 where every value is null.

    ``times``: how often each value counts.
    """
    kept = _within(value)
    wild = f"CAST({value} IS NOT NULL AND NOT abs({value}) < {REACH!r}D AS BIGINT)"
    often = "" if times == "1L" else f" * {times}"
    return _sums([_limb(f"({kept})", k) + often for k in range(TOP + 1)], wild, over, wide)


def halves(value: str, name: str) -> dict[str, str]:
    """Columns to be added before ``exact_stddev``: a value's two halves of 26 bits."""
    kept = f"({_within(value, REACH**0.5)})"
    high = f"({kept} * {_SPLITTER} - ({kept} * {_SPLITTER} - {kept}))"
    return {f"{name}_high": high, f"{name}_low": f"{kept} - {high}"}


def square_sums(value: str, name: str, wide: bool = False) -> str:
    """Sums of the limbs of squares: each square is three exact products of halves."""
    high, low = f"{name}_high", f"{name}_low"
    products = (f"({high} * {high})", f"(2D * {high} * {low})", f"({low} * {low})")
    parts = [" + ".join(_limb(p, k) for p in products) for k in range(TOP + 1)]
    return _sums(parts, f"CAST({value} IS NOT NULL AND {high} IS NULL AS BIGINT)", "", wide)


def minus(a: str, b: str) -> str:
    """The difference of two sums; a null ``b`` counts as 0."""
    return f"array({', '.join(f'{a}[{k}] - coalesce({b}[{k}], 0L)' for k in range(TOP + 2))})"


def total(sums: str) -> str:
    """The nearest double of limb sums."""
    # Limb k with the carries from below, for limbs of either sign.
    carried = lambda k: f"l[{k}]" if k == 0 else f"(l[{k}] + shiftright({carried(k - 1)}, 32))"
    signed = f"if({carried(TOP)} < 0, transform(l, x -> -x), l)"
    digits = [f"({carried(k)} & {RADIX - 1}L)" for k in range(TOP)] + [carried(TOP)]

    def window(first: int) -> str:
        """96 bits from the first digit on as one number; what lies below only breaks ties."""
        below = " OR ".join(f"d[{k}] > 0" for k in range(first - 2))
        last = f"d[{first - 2}]" + (f" | CAST({below} AS BIGINT)" if below else "")
        whole = f"CAST(d[{first}] AS DECIMAL(38, 0)) * {RADIX**2}BD + CAST(d[{first - 1}] AS DECIMAL(38, 0)) * {RADIX}BD"
        return f"CAST({whole} + CAST({last} AS DECIMAL(38, 0)) AS DOUBLE) * {2.0 ** PLACES[first - 2]!r}D"

    size = f"CASE WHEN d[4] > 0 THEN {window(4)} WHEN d[3] > 0 THEN {window(3)} ELSE {window(2)} END"
    value = let("l", signed.replace("l[", "n[").replace("(l,", "(n,").replace(", l)", ", n)"), let("d", f"array({', '.join(digits)})", size))
    sign = carried(TOP).replace("l[", "n[")
    return let("n", sums, f"CASE WHEN n[{TOP + 1}] = 0 THEN if({sign} < 0, -1D, 1D) * {value} END")


def exact_sum(value: str, wide: bool = False) -> str:
    """Sum of a column; 0 where every value is null."""
    return total(limb_sums(value, wide=wide))


def exact_avg(value: str, wide: bool = False) -> str:
    """Mean of a column; null where every value is null."""
    return f"try_divide({exact_sum(value, wide)}, CAST(count({value}) AS DOUBLE))"


def _product(a: str, b: str) -> str:
    """Product of two doubles as a struct of its nearest double and the exact rest."""
    split = lambda x: f"({x} * {_SPLITTER} - ({x} * {_SPLITTER} - {x}))"
    p, ah, bh = f"({a} * {b})", split(a), split(b)
    al, bl = f"({a} - {ah})", f"({b} - {bh})"
    rest = f"(({ah} * {bh} - {p}) + {ah} * {bl} + {al} * {bh}) + {al} * {bl}"
    return f"named_struct('h', {p}, 'l', {rest})"


def exact_stddev(value: str, name: str, wide: bool = False) -> str:
    """Sample standard deviation of a column with ``halves`` under a name; null below two values.

    Sum and sum of squares are taken as two doubles each, so that a small spread far from 0
    survives the subtraction.
    """

    def pair(sums: str) -> str:
        rest = total(minus("t.l", limbs("t.h", RADIX * REACH)))
        return let("t", let("q", sums, f"named_struct('l', q, 'h', {total('q')})"), f"named_struct('h', t.h, 'l', {rest})")

    spread = let(
        "e", _product("s.h", "s.h"), let("f", _product("c", "q.h"), "(f.h - e.h) + ((f.l - e.l) + (c * q.l - 2D * s.h * s.l - s.l * s.l))")
    )
    body = let("s", pair(limb_sums(value, wide=wide)), let("q", pair(square_sums(value, name, wide)), spread))
    root = let("v", body, "CASE WHEN v IS NOT NULL THEN sqrt(greatest(v, 0D) / c / (c - 1D)) END")
    return let("c", f"CAST(count({value}) AS DOUBLE)", f"CASE WHEN c > 1D THEN {root} END")
