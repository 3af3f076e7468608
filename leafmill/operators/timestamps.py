"""Mixed timestamp texts to one UTC instant.

Method: the distinct (text, locale, zone) triples of a table form a dictionary; each entry is parsed exhaustively
once, the dictionary can be persisted and extended incrementally, and instants are joined back to the rows. Relative
texts ("yesterday", "8 hours ago") parse to a rule in the dictionary; the rule is applied to the row's own
reference time.

Defined results: null, empty, blank and undecodable texts, impossible dates and clock times give no instant (null
from :func:`normalise_timestamps`, no row from :func:`found_instants`). A missing zone name is taken as UTC, and so is an unknown one, unless ``strict_zones`` is set: then
only texts with a zone of their own and counts of weeks and less have an instant (keep one stored dictionary for each setting). A null locale counts as ``en_US``. Two-digit years are 1969-2068. Months and years back are calendar months in the zone. Repeated rows stay repeated in :func:`normalise_timestamps`.
"""

from __future__ import annotations

import re
import unicodedata
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.session import cut

#: A text that holds more than one part in HEAVY of all rows is joined by broadcast: there are fewer than HEAVY of them.
HEAVY = 64
DAY_US = 86_400_000_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DICTIONARY_SCHEMA = "raw string, locale string, tz string, kind string, epoch_us long, amount_us long"

ZONES = {
    "UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "BST": 60, "WEST": 60, "IST": 330, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120, "EET": 120, "EEST": 180, "MSK": 180, "JST": 540,
    "HKT": 480, "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
MONTHS: dict[str, int] = {}
for _names in (
    "january february march april may june july august september october november december",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "jan feb mär apr mai jun jul aug sep okt nov dez",
    "jänner feber mrz apr mai jun jul aug sept okt nov dez",
    "一月 二月 三月 四月 五月 六月 七月 八月 九月 十月 十一月 十二月",
):
    MONTHS |= {n: i for i, n in enumerate(_names.split(), 1)}
_MONTH = "|".join(sorted(map(re.escape, MONTHS), key=len, reverse=True))

_LEAD = re.compile(
    r"^(?:最后修改于|最后更新于|创建于|修改于|更新于|last (?:modified|updated|changed)(?: (?:on|at))?|modified(?: on)?|updated(?: on)?|created(?: on)?|zuletzt (?:geändert|aktualisiert|bearbeitet)(?: am)?|geändert(?: am)?|erstellt(?: am)?)\s*:?\s*",
    re.I,
)
_WEEKDAY = re.compile(
    r"^(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?|montag|dienstag|mittwoch|donnerstag|freitag|samstag|sonntag|mo|di|mi|do|fr|sa|so|(?:星期|周)[一二三四五六日天])\b[.,]*\s*",
    re.I,
)
_CLOCK = r"(?P<h>\d{1,2})(?:[:时点](?P<mi>\d{1,2})(?:分)?(?:[:]?(?P<s>\d{1,2})秒?(?:[.,](?P<f>\d+))?)?)"
_HALF = r"(?P<ap>上午|下午|凌晨|早上|中午|晚上)?\s*"
_TAIL = r"\s*(?P<pm>[ap]\.?m\.?(?![a-z]))?(?:\s*uhr)?\s*(?P<z>z|[+-]\d{2}:?\d{2}|[+-]\d{2}|(?:utc|gmt)[+-]\d{1,2}(?::?\d{2})?|[a-z]{1,5}|[a-z]+(?:/[a-z_+-]+\d*)+)?(?:\s*\[(?P<zn>[^\]]+)\])?$"
_TIME = rf"(?:(?:\s*,\s*|\s+at\s+|\s+um\s+|\s*t\s*|\s*){_HALF}{_CLOCK}{_TAIL}|\s*)$"
_DATES = [
    re.compile(rf"^(?P<y>\d{{4}})(?P<sep>[-/.])(?P<m>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}})(?!\d){_TIME}", re.I),
    re.compile(rf"^(?P<y>\d{{4}})\s*年\s*(?P<m>\d{{1,2}})\s*月\s*(?P<d>\d{{1,2}})\s*日{_TIME}", re.I),
    re.compile(rf"^(?P<a>\d{{1,2}})(?P<sep>[-/.])(?P<b>\d{{1,2}})(?P=sep)(?P<y>\d{{4}})(?!\d){_TIME}", re.I),
    re.compile(rf"^(?P<mon>{_MONTH})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?\s*,?\s+(?P<y>\d{{4}})(?!\d){_TIME}", re.I),
    re.compile(rf"^(?P<d>\d{{1,2}})(?:st|nd|rd|th|\.)?\s*(?:of\s+)?(?P<mon>{_MONTH})\.?\s*,?\s+(?P<y>\d{{4}})(?!\d){_TIME}", re.I),
]
_COMPACT = re.compile(r"^(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})?(?:[.,](\d+))?(z|[+-]\d{2}:?\d{2})?$", re.I)
_DAY8 = re.compile(r"^(\d{4})(\d{2})(\d{2})$")
_SHORT_YEARS = [
    re.compile(rf"^(?P<a>\d{{1,2}})(?P<sep>[-/.])(?P<b>\d{{1,2}})(?P=sep)(?P<y>\d{{2}})(?!\d){_TIME}", re.I),
    re.compile(rf"^(?P<mon>{_MONTH})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?\s*,?\s+'?(?P<y>\d{{2}})(?![\d:]){_TIME}", re.I),
    re.compile(rf"^(?P<d>\d{{1,2}})(?:st|nd|rd|th|\.)?\s*(?:of\s+)?(?P<mon>{_MONTH})\.?\s*,?\s+'?(?P<y>\d{{2}})(?![\d:]){_TIME}", re.I),
]
_WEEK = re.compile(rf"^(?P<y>\d{{4}})-?w(?P<w>\d{{2}})-?(?P<wd>[1-7])(?!\d){_TIME}", re.I)
_EPOCH_PART = re.compile(r"^(-?)(\d{9,10})\.(\d+)$")
_EPOCH = re.compile(r"^-?(?:\d{9,10}|\d{12,13}|\d{15,16}|\d{18,19})$")
_DAY_WORD = re.compile(
    rf"^(?P<w>昨天|昨日|前天|今天|今日|yesterday|today|gestern|vorgestern|heute)(?:\s*(?:,|at|um)?\s*{_HALF}{_CLOCK}\s*(?P<pm>[ap]\.?m\.?)?(?:\s*uhr)?)?$", re.I
)
_AGO = re.compile(
    r"^(?:vor\s+)?(?P<n>\d+|an?|one|einer?|einem)\s*(?P<u>秒钟?|分钟|个?小时|天|周|个月|年|seconds?|minutes?|mins?|hours?|days?|weeks?|months?|years?|sekunden?|minuten?|stunden?|tage?n?|wochen?|monat(?:en)?|jahr(?:en)?)\s*(?P<x>之?前|ago)?$", re.I
)
_LAST = re.compile(r"^(?:last (week|month|year)|letzte[ns]? (woche|monat|jahr)|(上周|上个?月|去年))$", re.I)
_DAYS_BACK = {"昨天": 1, "昨日": 1, "yesterday": 1, "gestern": 1, "前天": 2, "vorgestern": 2, "今天": 0, "今日": 0, "today": 0, "heute": 0}
_UNITS = [("秒", 1), ("分", 60), ("小时", 3600), ("个小时", 3600), ("天", 86400), ("周", 604800), ("sec", 1), ("sek", 1), ("min", 60), ("hour", 3600), ("stund", 3600), ("day", 86400), ("tag", 86400), ("week", 604800), ("woche", 604800)]
_MONTH_UNITS = [("个月", 1), ("month", 1), ("monat", 1), ("年", 12), ("year", 12), ("jahr", 12)]
#: Amounts beyond these can't lead to a date.
MOST_MONTHS, MOST_US = 24_000, 1 << 60


@lru_cache(maxsize=1024)
def _zone(name: str | None):
    """UTC for a missing name, None for an unknown one."""
    try:
        return ZoneInfo(name) if name else timezone.utc
    except Exception:
        return None


def _offset(text: str | None):
    """The zone a text names, or None if it names none that is known."""
    if not text:
        return None
    up = text.upper()
    if up in ZONES:
        return timezone(timedelta(minutes=ZONES[up]))
    m = re.match(r"^(?:UTC|GMT)?([+-])(\d{1,2}):?(\d{2})?$", up)
    if m:
        minutes = int(m[2]) * 60 + int(m[3] or 0)
        return timezone(timedelta(minutes=minutes if m[1] == "+" else -minutes)) if minutes < 1440 else None
    if "/" in text:
        try:
            return ZoneInfo(text)
        except Exception:
            for part in (text.title(), "/".join(p.capitalize() for p in text.split("/"))):
                try:
                    return ZoneInfo(part)
                except Exception:
                    continue
    return None


def _epoch_us(naive: datetime, zone) -> int:
    """fold=0: the first of a doubled clock time; a skipped one moves on by the gap."""
    if zone is None:
        raise ValueError("unknown zone")
    delta = naive.replace(tzinfo=zone, fold=0).astimezone(timezone.utc) - EPOCH
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def _clock(g: dict) -> tuple[int, int, int, int] | None:
    h, mi, s = int(g["h"]), int(g["mi"] or 0), int(g.get("s") or 0)
    us = int(((g.get("f") or "") + "000000")[:6])
    half, pm = g.get("ap"), (g.get("pm") or "").lower().replace(".", "")
    if half or pm:
        if h > 12 or (pm and h == 0):
            return (h, mi, s, us) if half and h < 24 and mi < 60 and s < 60 else None
        if half in ("下午", "晚上") or pm == "pm":
            h = h % 12 + 12
        elif half == "中午":
            h = h if h >= 10 else h + 12
        else:
            h %= 12
    return (h, mi, s, us) if h < 24 and mi < 60 and s < 60 else None


def parse_timestamp(raw: str | None, locale: str | None, tz: str | None, strict_zones: bool = False) -> tuple[str, int | None, int | None]:
    """(kind, epoch_us, amount_us). Kinds: ``instant`` (epoch_us set), ``ago`` (amount_us back from the reference time),
    ``day`` (epoch_us = days back, amount_us = clock time on that day in the zone; ``day_utc`` where the zone is missing), ``months`` (epoch_us = months back
    in the zone; ``months_utc``), ``none``."""
    none = ("none", None, None)
    if raw is None:
        return none
    text = " ".join(unicodedata.normalize("NFKC", raw).split()).strip()
    text = text.replace("−", "-").replace("–", "-")
    if not text:
        return none
    text = _LEAD.sub("", text)
    home = _zone(tz)
    if home is None and not strict_zones:
        home, tz = timezone.utc, None
    try:
        if _EPOCH.match(text):
            value = int(text)
            size = len(text.lstrip("-"))
            return "instant", value * 1_000_000 if size <= 10 else value * 1000 if size <= 13 else value if size <= 16 else value // 1000, None
        if m := _EPOCH_PART.match(text):
            value = int(m[2]) * 1_000_000 + int((m[3] + "000000")[:6])
            return "instant", -value if m[1] else value, None
        if m := _COMPACT.match(text):
            zone = _offset(m[8]) or home
            us = int(((m[7] or "") + "000000")[:6])
            return "instant", _epoch_us(datetime(int(m[1]), int(m[2]), int(m[3]), int(m[4]), int(m[5]), int(m[6] or 0), us), zone), None
        if m := _DAY8.match(text):
            return "instant", _epoch_us(datetime(int(m[1]), int(m[2]), int(m[3])), home), None
        if m := _DAY_WORD.match(text):
            at = _clock(m.groupdict()) if m["h"] else (0, 0, 0, 0)
            if home is None:
                return none
            return (_by_zone("day", tz), _DAYS_BACK[m["w"].lower()], ((at[0] * 60 + at[1]) * 60 + at[2]) * 1_000_000 + at[3]) if at else none
        if (m := _AGO.match(text)) and (m["x"] or text.lower().startswith("vor ")):
            n = int(m["n"]) if m["n"].isdigit() else 1
            unit = m["u"].lower()
            if months := next((k for u, k in _MONTH_UNITS if unit.startswith(u)), 0):
                return _months_back(n * months, home, tz)
            amount = n * 1_000_000 * next(s for u, s in _UNITS if unit.lstrip("个").startswith(u))
            return ("ago", None, amount) if amount < MOST_US else none
        if m := _LAST.match(text):
            word = (m[1] or m[2] or m[3]).lower()
            if word in ("week", "woche", "上周"):
                return "ago", None, 7 * DAY_US
            return _months_back(12 if word in ("year", "jahr", "去年") else 1, home, tz)
        text = _WEEKDAY.sub("", text)
        for pattern in (*_DATES, *_SHORT_YEARS, _WEEK):
            if not (m := pattern.match(text)):
                continue
            g = m.groupdict()
            year = int(g["y"])
            if len(g["y"]) == 2:  # 69-99 are of the last century
                year += 1900 if year > 68 else 2000
            if g.get("wd"):
                day_of = datetime.fromisocalendar(year, int(g["w"]), int(g["wd"]))
                year, month, day = day_of.year, day_of.month, day_of.day
            elif g.get("mon"):
                month, day = MONTHS[g["mon"].lower()], int(g["d"])
            elif g.get("m"):
                month, day = int(g["m"]), int(g["d"])
            else:
                first, second = int(g["a"]), int(g["b"])
                month, day = (first, second) if (locale or "en_US") in ("en_US", "en-US") and g["sep"] != "." else (second, first)
            at = _clock(g) if g.get("h") else (0, 0, 0, 0)
            if at is None:
                return none
            zone = _offset(g.get("z")) or _offset(g.get("zn"))
            if zone is None and (g.get("z") or g.get("zn")):
                return none
            return "instant", _epoch_us(datetime(year, month, day, *at), zone or home), None
    except (ValueError, OverflowError):
        return none
    return none


def _by_zone(kind: str, tz: str | None) -> str:
    return kind if tz else kind + "_utc"


def _months_back(months: int, home, tz: str | None) -> tuple[str, int | None, int | None]:
    return (_by_zone("months", tz), months, None) if home is not None and months <= MOST_MONTHS else ("none", None, None)


def _parse_batches(batches, strict_zones: bool):
    for pdf in batches:
        null = lambda v: None if v is None or v != v else v
        out = [parse_timestamp(null(r), null(lo), null(z), strict_zones) for r, lo, z in zip(pdf["raw"], pdf["locale"], pdf["tz"])]
        yield pd.DataFrame(
            {
                "raw": pdf["raw"], "locale": pdf["locale"], "tz": pdf["tz"], "kind": [k for k, _, _ in out],
                "epoch_us": pd.array([e for _, e, _ in out], dtype="Int64"), "amount_us": pd.array([a for _, _, a in out], dtype="Int64"),
            }
        )


def build_dictionary(keys: DataFrame, stored: DataFrame | None = None, strict_zones: bool = False) -> DataFrame:
    """Parse the distinct (raw, locale, tz) of ``keys`` once; entries that ``stored`` already has are not parsed again.

    Returns only the new entries; add them to the stored table to extend it incrementally.
    """
    fresh = keys.select("raw", "locale", "tz")
    if stored is not None:
        same = [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("raw", "locale", "tz")]
        fresh = fresh.alias("k").join(stored.alias("s"), same, "left_anti")
    return fresh.mapInPandas(lambda b: _parse_batches(b, strict_zones), DICTIONARY_SCHEMA)


def normalise_timestamps(
    df: DataFrame, text_col: str, locale_col: str, tz_col: str, reference_col: str, dictionary_path: str | None = None, out_col: str = "epoch_us", strict_zones: bool = False
) -> DataFrame:
    """``df`` with ``out_col``: the UTC instant (microseconds) of each text, null where it denotes none.

    Extra columns pass through unchanged; an existing ``out_col`` is replaced. With ``dictionary_path`` the dictionary is read from
    that Parquet table (on shared storage) and extended, so later runs parse only texts not seen before. Every run writes its new entries to a folder named by
    their keys: a repeated run replaces its own, and entries that runs at the same time both wrote count once.
    """
    spark = df.sparkSession
    key = F.struct(F.col(text_col).alias("raw"), F.col(locale_col).alias("locale"), F.col(tz_col).alias("tz"))
    rows = df.drop(out_col) if out_col in df.columns and out_col not in (text_col, locale_col, tz_col, reference_col) else df
    kept = [c for c in rows.columns if c != out_col]
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__row"), key.alias("__key"), F.col(reference_col).alias("__ref"))
    counts = rows.where(F.col("__key.raw").isNotNull()).groupBy("__key").agg(F.count("*").alias("n"))
    counts = cut(counts.select("__key.raw", "__key.locale", "__key.tz", "n"))
    stored = _stored(spark, dictionary_path)
    entries = cut(build_dictionary(counts, stored, strict_zones))
    if dictionary_path:
        _store(entries, dictionary_path)
    if stored is not None:
        entries = entries.unionByName(stored)
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.where((F.col("n") >= 1000) & (F.col("n") * HEAVY > total)).select(F.struct("raw", "locale", "tz").alias("__hot"))
    entries = entries.where(F.col("kind") != "none").select(F.struct("raw", "locale", "tz").alias("__id"), "kind", F.col("epoch_us").alias("__e"), "amount_us")
    same = lambda a, b: (
        (F.col(f"{a}.raw") == F.col(f"{b}.raw")) & F.col(f"{a}.locale").eqNullSafe(F.col(f"{b}.locale")) & F.col(f"{a}.tz").eqNullSafe(F.col(f"{b}.tz"))
    )
    marked = rows.join(F.broadcast(heavy), same("__key", "__hot"), "left")
    hot_entries = entries.join(F.broadcast(heavy), same("__id", "__hot"), "left_semi")
    hot = marked.where(F.col("__hot").isNotNull()).join(F.broadcast(hot_entries), same("__key", "__id"), "left")
    rest = marked.where(F.col("__hot").isNull()).join(entries, same("__key", "__id"), "left")
    zone = F.when(F.col("kind").isin("day", "months"), F.col("__key.tz")).otherwise(F.lit("UTC"))
    ref_us = F.unix_micros(F.col("__ref"))
    local = F.from_utc_timestamp(F.col("__ref"), zone)
    local_us = F.unix_micros(local)
    earlier = local - F.make_ym_interval(F.lit(0), F.when(F.col("kind").isin("months", "months_utc"), F.col("__e")).cast("int"))
    day_us = (F.floor(local_us / DAY_US) - F.col("__e")) * DAY_US
    clock = F.timestamp_micros(day_us + F.col("amount_us"))
    value = (
        F.when(F.col("kind") == "instant", F.col("__e"))
        .when(F.col("kind") == "ago", ref_us - F.col("amount_us"))
        .when(F.col("kind").isin("months", "months_utc"), F.unix_micros(F.to_utc_timestamp(earlier, zone)))
        .when(F.col("kind").isin("day", "day_utc"), F.unix_micros(F.to_utc_timestamp(clock, zone)))
    )
    return hot.unionByName(rest).select(*[F.col(f"__row.`{c}`").alias(c) for c in kept], value.alias(out_col))


def _stored(spark: SparkSession, path: str | None) -> DataFrame | None:
    if not path:
        return None
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.schema(DICTIONARY_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException:
        return None
    return cut(found.dropDuplicates(["raw", "locale", "tz"]))


def _store(entries: DataFrame, path: str) -> None:
    mark = entries.agg(F.count("*").alias("n"), F.sum(F.xxhash64("raw", "locale", "tz").cast("decimal(38,0)")).alias("h")).first()
    if mark["n"]:
        entries.write.mode("overwrite").parquet(f"{path}/keys-{mark['n']}-{int(mark['h']) % (1 << 64):016x}")


def found_instants(meta: DataFrame, trees: DataFrame) -> DataFrame:
    """(meta_id, epoch_us): one row per meta_id whose last_modified denotes an instant."""
    sites = trees.select(F.col("tree_id").alias("t"), "locale", "tz").dropDuplicates(["t"])
    rows = meta.select("meta_id", "tree_id", "last_modified", "extracted_at")
    rows = rows.where(F.col("last_modified").isNotNull() & F.col("meta_id").isNotNull()).dropDuplicates(["meta_id"])
    rows = rows.join(sites, F.col("tree_id") == F.col("t"), "left")
    out = normalise_timestamps(rows, "last_modified", "locale", "tz", "extracted_at")
    return out.where(F.col("epoch_us").isNotNull()).select("meta_id", "epoch_us")
