"""Problem 6: one UTC instant for each written time that names exactly one.

Written forms are read by a few patterns into fields (JVM-side, no Python). A time with an offset, or
a Unix time, is an instant already. A time without zone is placed by an as-of join: per zone and local
year there is one row with the intervals of local time in which each offset holds. Two intervals around
a local time mean that a clock change repeats it, none that it is skipped, one gives the offset.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import lru_cache
from itertools import takewhile
from itertools import chain
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Years of local times that are placed; others are no case.
FIRST_YEAR, LAST_YEAR = 1900, 2100
#: The tz database has under 600 zones; a rule table with more distinct ones than this is refused, so the broadcast stays small.
MOST_ZONES = 1000

# Month names as written in the eight languages, January to December.
MONTH_NAMES = (
    "january february march april may june july august september october november december",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "jan feb mar apr may jun jul aug sept oct nov dec",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
    "январь февраль март апрель май июнь июль август сентябрь октябрь ноябрь декабрь",
    "जनवरी फरवरी मार्च अप्रैल मई जून जुलाई अगस्त सितंबर अक्टूबर नवंबर दिसंबर",
    "जनवरी फ़रवरी मार्च अप्रैल मई जून जुलाई अगस्त सितम्बर अक्तूबर नवम्बर दिसम्बर",
)

_SPACE = r"[\s\u0085   -     　]+"
_MONTH = r"([^\d\s,./:-]+)\.?"
_ZONE = r"(?: ?(z|[a-z]{2,5}|(?:gmt|utc)?[+-]\d{2}:?(?:\d{2})?))?"
_CLOCK = r"(\d{1,2})(?::| ?h ?|\.)(\d{2})(?: ?min)?(?::(\d{2})(?:[.,]\d+)?)?(?: ?([ap])\.?m\.?)?"
_MIL = r"(\d{2})(\d{2})()()"
_LEAD = r",? ?(?:at |à |às |a las |alle |ore |um |в )?"
_TAIL = r"(?: ?(?:uhr|hrs|बजे|h))?"
_WEEKDAY = r"(?:[^\d\s,]+,? )?"
_DATE = r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"

# pattern, and the replacement year|month|day|hour|minute|second|half|zone; # stands for a day order still to be applied, w for an ISO week.
_FORMS = (
    (rf"^{_DATE}(?:[t ]{_CLOCK}{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7|$8|"),
    (r"^(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(?:(\d{2})(?:[.,]\d+)?)?" + _ZONE + ")?$", "$1|$2|$3|$4|$5|$6||$7|c"),
    (rf"^(\d{{4}})-?w(\d{{2}})-?(\d)(?:[t ]{_CLOCK}{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7|$8|w"),
    (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})(?:{_LEAD}{_CLOCK}{_TAIL}{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|#"),
    (rf"^{_WEEKDAY}(\d{{1,2}})(?:st|nd|rd|th|er|º|°|\.)?[ -](?:de )?{_MONTH}[ -](?:de )?(\d{{2}}|\d{{4}})(?: г\.?)?(?:{_LEAD}{_CLOCK}{_TAIL}{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|m"),
    (rf"^{_WEEKDAY}(\d{{1,2}})(?:st|nd|rd|th|er|º|°|\.)?[ -](?:de )?{_MONTH}[ -](?:de )?(\d{{2}}|\d{{4}}),? {_MIL}{_TAIL}{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7|$8|m"),
    (rf"^(?:[^\d\s,]+, )?{_MONTH} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:{_LEAD}{_CLOCK}{_TAIL}{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|m"),
)
_DIGITS = "".join(chr(c + k) for c in (0x966, 0x660, 0x6F0, 0xFF10) for k in range(10))


@lru_cache(maxsize=None)
def zone_intervals(zone: str, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> tuple[tuple[int, int, int, str], ...]:
    """(first local second, local second after the last, offset in seconds, abbreviation) of each stretch of one zone."""
    info = ZoneInfo(zone)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def at(s: int) -> tuple[int, str]:
        t = (epoch + timedelta(seconds=s)).astimezone(info)
        return int(t.utcoffset().total_seconds()), t.tzname() or ""

    low = int((datetime(first, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds()) - 2 * 86400
    high = int((datetime(last + 1, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds()) + 2 * 86400
    cuts, now, state = [low], low, at(low)
    while now < high:
        then = min(now + 7 * 86400, high)
        if (new := at(then)) != state:
            a, b = now, then  # the change lies in (a, b]
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (mid, b) if at(mid) == state else (a, mid)
            cuts.append(b)
            state = at(b)
            now = b
            continue
        now = then
    return tuple((s + at(s)[0], e + at(s)[0], *at(s)) for s, e in zip(cuts, [*cuts[1:], high]))


def interval_table(spark: SparkSession, zones: list[str]) -> DataFrame:
    """One row for each zone and local year: ``__zone``, ``__year``, ``__stretches`` array<struct<a, b, shift, abbr>>."""
    rows = []
    for zone in zones:
        try:
            parts = zone_intervals(zone)
        except (KeyError, ValueError, OSError):
            continue  # an unknown zone places nothing
        k = 0
        for year in range(FIRST_YEAR, LAST_YEAR + 1):
            start = int((datetime(year, 1, 1) - datetime(1970, 1, 1)).total_seconds())
            end = int((datetime(year + 1, 1, 1) - datetime(1970, 1, 1)).total_seconds())
            while k < len(parts) and parts[k][1] <= start - 86400:
                k += 1
            rows.append((zone, year, [p for p in takewhile(lambda p: p[0] < end + 86400, parts[k:]) if p[0] < end and p[1] > start]))
    kind = "__zone string, __year int, __stretches array<struct<a: bigint, b: bigint, shift: int, abbr: string>>"
    return spark.createDataFrame(rows, kind)


def _fields(value: Column) -> Column:
    text = F.regexp_replace(F.translate(F.lower(value), _DIGITS, "0123456789" * 4), _SPACE, " ")
    text = F.trim(text)
    out = F.lit(None).cast("string")
    for pattern, fields in reversed(_FORMS):
        out = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, fields)).otherwise(out)
    return F.struct(text.alias("text"), F.split(out, r"\|").alias("f"))


def instants(df: DataFrame, value_col: str, zone_col: str, order_col: str, out: str = "instant_s", status: str = "instant_status") -> DataFrame:
    """``df`` with the instant in whole seconds since 1970 UTC, or null, and why.

    ``zone_col`` names the zone of times that name none (and of abbreviations), ``order_col`` the order
    DMY, MDY or YMD of all-digit dates. The status is ``ok``, ``ambiguous``, ``nonexistent``, ``no_zone``
    or ``unreadable``; null and blank values are unreadable. Fractions are dropped. Rows and other
    columns stay as they are; columns named like the two results are replaced. No shuffle: the zone
    intervals are broadcast (at most ``MOST_ZONES`` zones, which is checked).
    """
    spark = df.sparkSession
    df = df.drop(out, status)
    zones = [r[0] for r in df.select(F.col(zone_col)).where(F.col(zone_col).isNotNull()).distinct().limit(MOST_ZONES + 1).collect()]
    return place(df, interval_table(spark, _checked(zones)), value_col, zone_col, order_col, out, status)


def _checked(zones: list[str]) -> list[str]:
    if len(zones) > MOST_ZONES:
        raise ValueError(f"more than {MOST_ZONES} time zones")
    return sorted(zones)


def place(df: DataFrame, table: DataFrame, value_col: str, zone_col: str, order_col: str, out: str, status: str) -> DataFrame:
    """As ``instants``, with the interval table given."""
    months = F.create_map(*chain.from_iterable((F.lit(n), F.lit(k)) for n, k in {n: k for names in MONTH_NAMES for k, n in enumerate(names.split(), 1)}.items()))
    keep = df.columns
    x = df.withColumn("__p", _fields(F.col(value_col)))
    f = lambda k: F.get(F.col("__p.f"), k)
    num = lambda c: c.try_cast("int")
    kind, order = f(8), F.upper(F.trim(F.col(order_col)))
    year = num(f(0))
    year = F.when(F.length(f(0)) == 2, year + F.when(year < 70, 2000).otherwise(1900)).otherwise(year)
    month = F.when(kind == "m", F.try_element_at(months, f(1))).when(kind == "#", F.when(order == "MDY", num(f(1))).when(order == "DMY", num(f(2)))).otherwise(num(f(1)))
    day = F.when(kind == "#", F.when(order == "MDY", num(f(2))).when(order == "DMY", num(f(1)))).otherwise(num(f(2)))
    half, hour = f(6), F.coalesce(num(F.nullif(f(3), F.lit(""))), F.lit(0))
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    minute = F.coalesce(num(F.nullif(f(4), F.lit(""))), F.lit(0))
    second = F.coalesce(num(F.nullif(f(5), F.lit(""))), F.lit(0))
    x = x.select(*keep, F.col("__p.text").alias("__t"), kind.alias("__k"), f(7).alias("__z"), year.alias("__y"), month.alias("__m"), day.alias("__d"), hour.alias("__h"), minute.alias("__i"), second.alias("__s"))
    jan4 = F.expr("try_make_timestamp_ntz(__y, 1, 4, 0, 0, 0D)").cast("date")
    week = F.expr("date_add(date_sub(__j, weekday(__j)), (__m - 1) * 7 + __d - 1)")
    x = x.withColumn("__j", jan4)
    date = F.when(F.col("__k") == "w", F.when(F.col("__d").between(1, 7) & F.col("__m").between(1, 53) & (F.weekofyear(week) == F.col("__m")), week)).otherwise(F.expr("try_make_timestamp_ntz(__y, __m, __d, 0, 0, 0D)").cast("date"))
    ok = F.col("__h").between(0, 23) & F.col("__i").between(0, 59) & F.col("__s").between(0, 59)
    local = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.col("__h") * 3600 + F.col("__i") * 60 + F.col("__s")
    x = x.withColumn("__l", F.when(ok, local)).withColumn("__ly", F.when(F.col("__l").isNotNull(), F.year(date)))
    # a number that isn't a calendar time: seconds, milliseconds or microseconds by its length
    number = F.when(F.col("__t").rlike(r"^\d{5,17}$") & F.col("__l").isNull(), F.col("__t").cast("bigint"))
    size = F.length("__t")
    unix = F.when(number.isNotNull(), F.when(size <= 11, number).when(size <= 14, F.expr("try_cast(__t as bigint) div 1000")).otherwise(F.expr("try_cast(__t as bigint) div 1000000")))
    unix = F.when(unix < (LAST_YEAR - 1970) * 31556952, unix)
    zone = F.regexp_replace(F.col("__z"), "^(gmt|utc)(?=[+-])", "")
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    given = F.when(zone.isin("z", "utc", "gmt", "ut"), 0).when(zone.rlike(r"^[+-]\d{2}:?(\d{2})?$"), sign * (F.substring(digits, 1, 2).cast("int") * 3600 + F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).cast("int"), F.lit(0)) * 60))
    x = x.withColumn("__u", unix).withColumn("__g", given)
    j = x.join(F.broadcast(table), (F.col(zone_col) == F.col("__zone")) & (F.col("__ly") == F.col("__year")), "left")
    named = F.array_distinct(F.transform(F.filter("__stretches", lambda s: F.lower(s["abbr"]) == F.col("__z")), lambda s: s["shift"]))
    here = F.filter("__stretches", lambda s: (F.col("__l") >= s["a"]) & (F.col("__l") < s["b"]))
    j = j.withColumn("__n", named).withColumn("__w", here)
    readable = F.col("__l").isNotNull()
    bare = readable & (F.coalesce(F.col("__z"), F.lit("")) == "")
    instant = (
        F.when(F.col("__u").isNotNull(), F.col("__u"))
        .when(readable & F.col("__g").isNotNull(), F.col("__l") - F.col("__g"))
        .when(bare & (F.size("__w") == 1), F.col("__l") - F.get("__w", 0)["shift"])
        .when(readable & ~bare & (F.size("__n") == 1), F.col("__l") - F.get("__n", 0))
    )
    j = j.withColumn("__r", instant)
    why = (
        F.when(F.col("__r").isNotNull(), "ok")
        .when(bare & F.col("__stretches").isNull(), "no_zone")
        .when(bare & (F.size("__w") > 1), "ambiguous")
        .when(bare & (F.size("__w") == 0), "nonexistent")
        .otherwise("unreadable")
    )
    return j.select(*keep, F.col("__r").cast("bigint").alias(out), why.alias(status))


def site_key(url: Column) -> Column:
    """The host of a URL in lower case, without ``www.`` and port; null where there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def published_instants(entries: DataFrame, parsed: DataFrame, rules: DataFrame) -> DataFrame:
    """``kind``, ``row_key``, ``instant_s`` of each entry and parsed document whose published_date names one instant.

    A row delivered twice counts once. Rows of a source without rules count if their value names its zone.
    """
    spark = entries.sparkSession
    rules = rules.select("source_id", "site_key", "time_zone", "date_order")
    zones = [r[0] for r in rules.where(F.col("time_zone").isNotNull()).select("time_zone").distinct().limit(MOST_ZONES + 1).collect()]
    table = interval_table(spark, _checked(zones))
    a = entries.select(F.lit("entry").alias("kind"), F.col("entry_id").cast("string").alias("row_key"), "source_id", "published_date").join(rules.drop("site_key"), "source_id", "left")
    b = parsed.select(F.lit("parsed").alias("kind"), F.col("doc_id").alias("row_key"), site_key(F.col("url")).alias("site_key"), "published_date").join(rules.drop("source_id"), "site_key", "left")
    every = a.select("kind", "row_key", "published_date", "time_zone", "date_order").unionByName(b.select("kind", "row_key", "published_date", "time_zone", "date_order"))
    done = place(every, table, "published_date", "time_zone", "date_order", "instant_s", "instant_status")
    return done.where(F.col("instant_s").isNotNull()).select("kind", "row_key", "instant_s").distinct()
