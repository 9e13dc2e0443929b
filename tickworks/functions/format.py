"""Display texts as column expressions (all built-in, JVM-side).

F8   or_na              'N/A' when a min/max is missing
F9   alert_text         '⬆ SURGE 1.234% from SMA $1.2345'
F10  price_text         '$1234.5679'; '—' when the price is null or zero
F11  grouped_int        '1,234,567'
F12  ts_text            'yyyy-MM-dd HH:mm:ss' (first 19 characters of the text)
F13  sma_text           'SMA=$1.2345' or 'SMA=building...' when missing or zero
F14  age_text           seconds with one decimal
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PRICE_SURGE

# Fixed values (display texts).
MISSING_PRICE = "—"
NOT_AVAILABLE = "N/A"
SURGE_LABEL = "⬆ SURGE"
DROP_LABEL = "⬇ DROP"
SMA_BUILDING = "SMA=building..."


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


_SPLIT = 134217729.0   # 2^27 + 1, Dekker's splitting constant


def fixed(x: Column | str, k: int) -> Column:
    """``'%.{k}f' % x`` as C and Python print it, built from plain arithmetic.

    ``format_string`` (java.util.Formatter) rounds the shortest decimal text of
    the double half-up, so 37.8125 prints as 37.813 where C and Python print
    37.812 (they round the exact binary value, half-even on exact ties). Here
    product f·10^k of the fraction f is computed with its exact rounding error
    (Dekker's split; 10^k has few significant bits so only f is split), which
    decides on which side of the half the exact value lies (k <= 6). NaN and
    infinities print as ``nan`` and ``inf``; from 2^53 on, where doubles have no
    fraction, the shortest digits are printed, filled with zeros.
    """
    x = _c(x).cast("double")
    size = F.abs(x)
    whole = F.floor(size)
    a = size % 1        # exact
    scale = float(10 ** k)
    p = a * F.lit(scale)
    t = a * F.lit(_SPLIT)
    hi = t - (t - a)
    lo = a - hi
    err = (hi * F.lit(scale) - p) + lo * F.lit(scale)
    n = F.floor(p)
    d = p - n - F.lit(0.5)
    up = (d > 0) | ((d == 0) & ((err > 0) | ((err == 0) & ((n if k else whole) % 2 == 1))))
    m = n + F.when(up, F.lit(1)).otherwise(F.lit(0))
    ip = (whole + F.when(m >= 10 ** k, F.lit(1)).otherwise(F.lit(0))).cast("string")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    if k == 0:
        body = ip
    else:
        frac = F.lpad((m % F.lit(10 ** k)).cast("bigint").cast("string"), k, "0")
        body = F.concat(ip, F.lit("."), frac)
    return (F.when(F.isnan(x), F.lit("nan"))
            .when(size == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
            .when(size < F.lit(2.0 ** 53), F.concat(sign, body))
            .when(x.isNotNull(), F.format_string(f"%.{k}f", x)))


def dollars(p: Column | str) -> Column:
    """'$%.4f' of a value that is always shown (null stays null)."""
    return F.concat(F.lit("$"), fixed(p, 4))


def price_text(p: Column | str) -> Column:
    p = _c(p)
    return F.when(p.isNull() | (p == 0), F.lit(MISSING_PRICE)).otherwise(dollars(p))


def or_na(p: Column | str) -> Column:
    p = _c(p)
    return F.when(p.isNull(), F.lit(NOT_AVAILABLE)).otherwise(dollars(p))


def grouped_int(v: Column | str) -> Column:
    return F.format_number(_c(v), 0)


def ts_text(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def sma_text(sma: Column | str) -> Column:
    s = _c(sma)
    return F.when(s.isNull() | (s == 0), F.lit(SMA_BUILDING)).otherwise(
        F.concat(F.lit("SMA=$"), fixed(s, 4)))


def alert_text(alert_type: Column | str, deviation: Column | str, sma: Column | str) -> Column:
    """Null when there is no alert."""
    a = _c(alert_type)
    label = F.when(a == F.lit(PRICE_SURGE), F.lit(SURGE_LABEL)).otherwise(F.lit(DROP_LABEL))
    return F.when(a.isNotNull(), F.concat(label, F.lit(" "), fixed(_c(deviation) * 100, 3),
                                          F.lit("% from SMA $"), fixed(sma, 4)))


def age_text(seconds: Column | str) -> Column:
    return fixed(seconds, 1)
