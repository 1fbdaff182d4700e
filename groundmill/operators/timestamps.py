"""Dates and times as found in texts, brought to one unambiguous form.

``normalise_times`` reads each value under every format that is valid for it. Where more than one
reading is valid (slashed dates), an expectation-maximisation over the mixture of formats of each
source decides: values add likelihood to each valid reading, posteriors choose one, and what stays
undecided is marked. A declared order of a source is a prior of weight one, so the other order has
no mass there.

Defined cases: null, blank and unreadable values give ``event_norm`` null; impossible dates likewise;
an unknown source or zone gives a null form for times without zone; repeated rows are kept as they come (callers
deduplicate by key); an empty table gives an empty table.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
import zoneinfo
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.common import broadcast_if_small, durable

# Month names in English, German, French and Spanish.
MONTHS = {
    1: "january jan januar janvier janv enero ene jänner",
    2: "february feb februar février fevrier févr febrero",
    3: "march mar märz mrz mars marzo maerz",
    4: "april apr avril avr abril abr",
    5: "may mai mayo",
    6: "june jun juni juin junio",
    7: "july jul juli juillet juil julio",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre",
    10: "october oct oktober okt octobre octubre",
    11: "november nov novembre noviembre",
    12: "december dec dezember dez décembre decembre diciembre dic",
}
#: Share of the posterior from which a reading counts as decided.
DECIDED = 0.95
#: The mixture is iterated until no weight moves by more than this.
EM_STEP = 1e-12
#: Offices are a small dimension; more than this many are refused rather than collected.
MAX_SOURCES = 100_000

_DAY0 = dt.date(1970, 1, 1).toordinal()
_MONTH = {name: n for n, names in MONTHS.items() for name in names.split()}
_NAME = r"(?P<b>[^\W\d_]+)\.?"
_HEAD = r"(?:(?P<hrs>\d{4}) hrs,? )?(?:[^\W\d_]{2,12}\.?,? )?"
_REST = r"(?P<rest>(?:,? |T).*)?"
#: Shapes whose date has one valid reading. Groups: y, m or b (a month's name), d, rest (time and zone).
_DATES = [
    re.compile(p)
    for p in (
        r"(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})" + _REST,
        r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4}|\d\d)" + _REST,
        _HEAD + r"(?P<d>\d{1,2})(?:st|nd|rd|th|er|\.|º)?[ -](?:de )?" + _NAME + r",?[ -](?:del? )?(?P<y>\d{4}|\d\d)(?!\d)" + _REST,
        _HEAD + _NAME + r" (?P<d>\d{1,2})(?:st|nd|rd|th)?,? (?P<y>\d{4})(?!\d)" + _REST,
    )
]
_SLASH = re.compile(r"(?P<a>\d{1,2})/(?P<b>\d{1,2})/(?P<y>\d{4}|\d\d)" + _REST)
_COMPACT = re.compile(r"(\d{4})(\d\d)(\d\d)(?:T?(?P<t>\d{4}(?:\d\d(?:[.,]\d+)?)?)(?P<z>Z|[+-]\d\d(?::?\d\d)?)?)?")
_WEEK = re.compile(r"(\d{4})-?W(\d\d)-?([1-7])")
_YDAY = re.compile(r"(\d{4})-(\d{3})")
_YM = re.compile(r"(?P<y>\d{4})-(?P<m>\d\d)|(?P<m2>\d{1,2})/(?P<y2>\d{4})|" + _NAME + r" (?:de )?(?P<y3>\d{4})|(?P<y4>\d{4})")
_REST_OF = re.compile(
    r"(?:T|,? (?:at |um |a las |à )?)?(?P<h>\d{1,2}):(?P<mi>\d\d)(?::(?P<s>\d\d)(?:[.,](?P<f>\d+))?)?(?: ?(?P<ap>[AaPp])\.?[Mm]\.?(?![A-Za-z]))?(?: ?Uhr)?"
    r" ?(?:\(?(?P<utc>Z|UTC|GMT)?(?P<off>[+-]\d\d(?::?\d\d)?)?\)?)?(?:\[(?P<iana>[A-Za-z_]+/[\w/+-]+)\]| ?(?P<iana2>[A-Z][A-Za-z_]+/[\w/+-]+)|(?P<abbr>[A-Z]{2,5}))?"
)


def _day(y, m, d) -> int | None:
    try:
        return dt.date(int(y) + 2000 * (len(y) == 2), int(m), int(d)).toordinal() - _DAY0
    except ValueError:
        return None


def _offset(text: str) -> int:
    digits = text[1:].replace(":", "").ljust(4, "0")
    return (int(digits[:2]) * 3600 + int(digits[2:]) * 60) * (-1 if text[0] == "-" else 1)


def _micros(h, mi, s="0", f="") -> int | None:
    if int(h) > 23 or int(mi) > 59 or int(s) > 59:
        return None
    return (int(h) * 3600 + int(mi) * 60 + int(s)) * 1_000_000 + int(f[:6].ljust(6, "0"))


#: What ``read_value`` gives; days and microseconds count from 1970 and from midnight.
READING = "shape string, day int, mdy int, dmy int, partial string, epoch_us long, time_us long, offset_s int, iana string, abbr string"
_FIELDS = [x.split()[0] for x in READING.split(", ")]
_UNREAD = (None,) * 9


def _rest(text: str | None) -> tuple | None:
    """(time_us, offset_s, iana, abbr) of what follows a date; None if it can't be read."""
    if not text:
        return None, None, None, None
    m = _REST_OF.fullmatch(text)
    if not m:
        return None
    h = m["h"]
    if m["ap"]:
        if not 1 <= int(h) <= 12:
            return None
        h = str(int(h) % 12 + 12 * (m["ap"] in "pP"))
    us = _micros(h, m["mi"], m["s"] or "0", m["f"] or "")
    if us is None:
        return None
    return us, _offset(m["off"]) if m["off"] else 0 if m["utc"] else None, m["iana"] or m["iana2"], m["abbr"]


def read_value(s: str) -> tuple:
    """Every valid reading of one squeezed value, in the order of READING without the shape."""
    for pattern in _DATES:
        if m := pattern.fullmatch(s):
            g = m.groupdict()
            month = g.get("m") or _MONTH.get(g["b"].lower())
            day, rest = (month and _day(g["y"], month, g["d"])), _rest(g["rest"])
            if day is None or rest is None or month is None:
                return _UNREAD
            if g.get("hrs"):
                us = _micros(g["hrs"][:2], g["hrs"][2:])
                return _UNREAD if us is None else (day, None, None, None, None, us, *rest[1:])
            return (day, None, None, None, None, *rest)
    if m := _SLASH.fullmatch(s):
        rest = _rest(m["rest"])
        return _UNREAD if rest is None else (None, _day(m["y"], m["a"], m["b"]), _day(m["y"], m["b"], m["a"]), None, None, *rest)
    if s.isdecimal() and s.isascii() and len(s) in (9, 10, 13):
        return (None, None, None, None, int(s) * (1000 if len(s) == 13 else 1_000_000), None, None, None, None)
    if m := _COMPACT.fullmatch(s):
        day, t, z = _day(m[1], m[2], m[3]), m["t"], m["z"]
        us = _micros(t[:2], t[2:4], t[4:6] or "0", t[7:]) if t else None
        if day is None or t and us is None:
            return _UNREAD
        return (day, None, None, None, None, us, None if not z else 0 if z == "Z" else _offset(z), None, None)
    if m := _WEEK.fullmatch(s):
        try:
            return (dt.date.fromisocalendar(*map(int, m.groups())).toordinal() - _DAY0, *_UNREAD[1:])
        except ValueError:
            return _UNREAD
    if m := _YDAY.fullmatch(s):
        first = _day(m[1], 1, 1)
        fits = first is not None and 1 <= int(m[2]) <= 365 + calendar.isleap(int(m[1]))
        return (first + int(m[2]) - 1, *_UNREAD[1:]) if fits else _UNREAD
    if m := _YM.fullmatch(s):
        y = m["y"] or m["y2"] or m["y3"] or m["y4"]
        month = m["m"] or m["m2"] or (m["b"] and _MONTH.get(m["b"].lower()))
        if int(y) == 0 or not m["y4"] and not 1 <= int(month or 0) <= 12:
            return _UNREAD
        return (None, None, None, y if m["y4"] else f"{y}-{int(month):02d}", *_UNREAD[4:])
    return _UNREAD


_LETTERS, _DIGITS, _BLANKS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"\s+")



def _read_series(values: pd.Series) -> pd.DataFrame:
    """One Arrow batch; repeated values are read once. Measured: some 10 µs a value, where the same
    patterns as Column expressions took 200 µs (generated methods too large to be compiled)."""
    read: dict[str | None, tuple] = {None: (None, *_UNREAD)}
    rows = []
    for v in values:
        if v not in read:
            s = _BLANKS.sub(" ", v).strip()
            got = read_value(s)
            # only what can be read has a shape, so there are as many shapes as the formats allow
            shape = None if got == _UNREAD else "count" if got[4] is not None else "partial" if got[3] else _DIGITS.sub("9", _LETTERS.sub("a", s))
            read[v] = (shape, *got)
        rows.append(read[v])
    out = pd.DataFrame(rows, columns=_FIELDS, dtype=object)
    return out.astype({c: "Int64" for c in ("day", "mdy", "dmy", "epoch_us", "time_us", "offset_s")})


def _em(counts: pd.DataFrame) -> pd.DataFrame:
    """One source: rows (shape, mdy valid, dmy valid, n), bounded by the number of shapes. Returns the
    posterior of month-first for each row and the weights of the formats at the end.

    Formats are the shapes, with month-first and day-first forms of each slashed shape; the order is
    shared by the slashed shapes of a source through a Dirichlet of pseudo-count one half."""
    n = counts["n"].to_numpy(float)
    mdy, dmy = counts["mdy"].to_numpy(bool), counts["dmy"].to_numpy(bool)
    declared = counts["declared"].iloc[0]
    prior = np.array([1.0, 1.0]) if declared not in ("MDY", "DMY") else np.array([declared == "MDY", declared == "DMY"], float)
    theta = prior / prior.sum()

    def expect(theta: np.ndarray) -> np.ndarray:
        like = np.stack([mdy * theta[0], dmy * theta[1]])
        total = like.sum(0)
        return np.divide(like[0], total, out=np.zeros(len(n)), where=total > 0)

    def step(theta: np.ndarray) -> np.ndarray:
        post, seen = expect(theta), (mdy & (theta[0] > 0)) | (dmy & (theta[1] > 0))
        new = (np.array([(n * post)[seen].sum(), (n * (1 - post))[seen].sum()]) + 0.5) * (prior > 0)
        return new / new.sum()

    # to the fixed point whatever the share of ambiguous values, which slows plain rounds without end: each round is two
    # steps and the limit that their ratio points to
    while abs((one := step(theta)) - theta).max() > EM_STEP:
        two = step(one)
        bend = two[0] - 2 * one[0] + theta[0]
        far = theta[0] - (one[0] - theta[0]) ** 2 / bend if bend else two[0]
        theta = np.array([far, 1 - far]) if 0 < far < 1 else two
    post = expect(theta)
    out = counts[["source", "shape", "mdy", "dmy"]].copy()
    out["p_mdy"], out["weight"], out["n"] = post, n / max(n.sum(), 1.0), counts["n"]
    out["readable"] = np.stack([mdy * theta[0], dmy * theta[1]]).sum(0) > 0
    out["theta_mdy"] = theta[0]
    return out


def mixtures(readings: DataFrame) -> DataFrame:
    """Weights per source and shape: counts are combined map-side; each source's few rows go to one task."""
    counts = readings.filter(F.col("_r.shape").isNotNull()).groupBy(
        F.col("_source").alias("source"), F.col("_r.shape").alias("shape"), F.col("_r.mdy").isNotNull().alias("mdy"), F.col("_r.dmy").isNotNull().alias("dmy")
    ).agg(F.count("*").alias("n"), F.max("_order").alias("declared"))
    return counts.groupBy("source").applyInPandas(_em, "source string, shape string, mdy boolean, dmy boolean, p_mdy double, weight double, n long, readable boolean, theta_mdy double")


def zone_abbreviations(zones: list[str]) -> dict[str, int]:
    """'zone|abbreviation' to offset in seconds, as the zone used it in 1990 to 2037."""
    out: dict[str, int] = {}
    for name in zones:
        try:
            zone = zoneinfo.ZoneInfo(name)
        except (zoneinfo.ZoneInfoNotFoundError, ValueError):
            continue
        for year in range(1990, 2038):
            for month in range(1, 13):
                t = dt.datetime(year, month, 15, tzinfo=zone)
                out[f"{name}|{t.tzname()}"] = int(t.utcoffset().total_seconds())
    return out


def read_values(values: DataFrame, offices: DataFrame, value: str = "event_date", source: str = "office", use_declared: bool = True) -> DataFrame:
    """``values`` with the readings of ``value`` (_r) and the zone and order of the office ``source``;
    written once, as both the mixtures and the choice use them."""
    known = offices.select(F.col("office_code").alias("_source"), F.col("zone_name").alias("_zone"), F.upper("date_order").alias("_order")).dropDuplicates(["_source"])
    joined = values.withColumn("_source", F.col(source)).join(broadcast_if_small(known), "_source", "left")
    if not use_declared:
        joined = joined.withColumn("_order", F.lit(None).cast("string"))
    return durable(joined.withColumn("_r", F.pandas_udf(_read_series, READING)(F.col(value))))


def normalise_times(values: DataFrame, offices: DataFrame, value: str = "event_date", source: str = "office", use_declared: bool = True) -> DataFrame:
    """``values`` plus ``event_norm``, ``precision`` (instant, day, month, year), ``p_reading`` and
    ``ambiguity`` (none, date_order, repeated_hour, skipped_hour). Columns of the input stay, whatever
    their names; one called as an added column is replaced."""
    clash = {c: f"in_{i}" for i, c in enumerate(values.columns)}
    renamed = values.withColumnsRenamed(clash)
    read = read_values(renamed, offices, clash[value], clash[source], use_declared)
    em = mixtures(read)
    em = durable(em.filter(F.col("mdy") | F.col("dmy")).select(F.col("source").alias("_m_source"), F.col("shape").alias("_m_shape"), F.col("mdy").alias("_m_mdy"), F.col("dmy").alias("_m_dmy"), "p_mdy", "readable"))
    r = lambda name: F.col(f"_r.{name}")
    has_mdy, has_dmy = r("mdy").isNotNull(), r("dmy").isNotNull()
    joined = read.join(broadcast_if_small(em), F.col("_source").eqNullSafe(F.col("_m_source")) & (r("shape") == F.col("_m_shape")) & (has_mdy == F.col("_m_mdy")) & (has_dmy == F.col("_m_dmy")), "left")
    sure = F.greatest("p_mdy", 1 - F.col("p_mdy"))
    chosen = joined.withColumns({
        "_sure": sure,
        "_open": (sure < DECIDED) & has_mdy & has_dmy & (r("mdy") != r("dmy")),
        "_pick": F.when(F.col("readable"), F.when(F.col("p_mdy") > 0.5, r("mdy")).otherwise(r("dmy"))),
    })
    rows = offices.select("zone_name").dropna().distinct().limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"offices has more than {MAX_SOURCES} zones")
    valid = zoneinfo.available_timezones()
    abbr = {k: v for k, v in zone_abbreviations(sorted(r[0] for r in rows if r[0] in valid)).items()} or {"": 0}
    abbr_map = F.create_map(*[F.lit(x) for kv in abbr.items() for x in kv])
    zones = sorted(valid)
    chosen = chosen.withColumns({
        "_day": F.coalesce(r("day"), F.when(~F.coalesce("_open", F.lit(False)), F.col("_pick"))),
        "_at": F.coalesce(F.when(r("iana").isin(zones), r("iana")), F.when(F.col("_zone").isin(zones), F.col("_zone"))),
        "_off": F.coalesce(r("offset_s"), F.when(r("iana").isNull(), F.try_element_at(abbr_map, F.concat_ws("|", "_zone", r("abbr"))))),
    })
    chosen = chosen.withColumn("_naive", F.col("_day").cast("bigint") * 86_400_000_000 + r("time_us"))
    chosen = chosen.withColumn("_local", F.when(F.col("_off").isNull(), F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("_naive"), F.col("_at")))))
    chosen = chosen.withColumns({
        "_us": F.coalesce(r("epoch_us"), F.col("_naive") - F.col("_off").cast("bigint") * 1_000_000, F.col("_local")),
        "_back": F.unix_micros(F.from_utc_timestamp(F.timestamp_micros("_local"), F.col("_at"))),
        # clocks go back by an hour, here and there by half an hour or two
        "_twice": reduce(lambda x, y: x | y, [F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(F.col("_local") + s * 1_000_000), F.col("_at"))) == F.col("_naive") for s in (1800, 3600, 7200)]),
        "_timed": r("time_us").isNotNull() | r("epoch_us").isNotNull(),
    })
    chosen = chosen.withColumn("_secs", F.floor(F.col("_us") / 1_000_000).cast("bigint"))
    in_day = F.pmod("_secs", F.lit(86400))
    instant = F.format_string(
        "%sT%02d:%02d:%02d.%06dZ",
        F.date_from_unix_date(F.floor(F.col("_secs") / 86400).cast("int")).cast("string"), F.floor(in_day / 3600).cast("int"), F.floor(in_day % 3600 / 60).cast("int"), (in_day % 60).cast("int"), F.pmod(F.col("_us"), F.lit(1_000_000)).cast("int"),
    )
    out = chosen.withColumn("_norm", F.when(F.col("_timed"), F.when(F.col("_us").isNotNull(), instant)).otherwise(F.coalesce(F.date_from_unix_date("_day").cast("string"), r("partial"))))
    norm = F.col("_norm")
    added = {
        "event_norm": norm,
        "precision": F.when(norm.isNull(), F.lit(None)).when(F.col("_timed"), "instant").when(F.length(norm) == 10, "day").when(F.length(norm) == 7, "month").otherwise("year"),
        "p_reading": F.when(has_mdy | has_dmy, F.col("_sure")).when(norm.isNotNull(), F.lit(1.0)),
        "ambiguity": F.when(F.col("_open"), "date_order").when(F.col("_back") != F.col("_naive"), "skipped_hour").when(F.col("_twice"), "repeated_hour").otherwise("none"),
    }
    return out.select(*[F.col(new).alias(old) for old, new in clash.items() if old not in added], *[c.alias(n) for n, c in added.items()])
