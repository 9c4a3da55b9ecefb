"""Dimension tables: country suffixes, ad hosts, site categories.

None of them is hinted for broadcast: Spark broadcasts a side whose size it knows
to be under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linklake import schemas
from linklake.functions.text import WHITESPACE

# The country codes that have a country suffix. The suffix is the
# lower-case code after a dot, and GB has a second one.
COUNTRY_CODES = """
AF AL DZ AD AO AG AR AM AU AT AZ BS BH BD BB BY BE BZ BJ BT BO BA BW BR BN BG BF BI
CV KH CM CA CF TD CL CN CO KM CD CG CR CI HR CU CW CY CZ DK DJ DM DO EC EG SV GQ ER
EE SZ ET FJ FI FR GA GM GE DE GH GR GD GT GN GW GY HT VA HN HU IS IN ID IR IQ IE IL
IT JM JP JO KZ KE KI KP KR KW KG LA LV LB LS LR LY LI LT LU MG MW MY MV ML MT MH MR
MU MX FM MD MC MN ME MA MZ MM NA NR NP NL NZ NI NE NG MK NO OM PK PW PS PA PG PY PE
PH PL PT QA RO RU RW KN LC VC WS SM ST SA SN RS SC SL SG SK SI SB SO ZA SS ES LK SD
SR SE CH SY TJ TZ TH TL TG TO TT TN TR TM TV UG UA AE GB US UY UZ VU VE VN YE ZM ZW
"""
SECOND_SUFFIXES = {".uk": "GB"}


def country_tlds(spark: SparkSession) -> DataFrame:
    """The built-in suffix table: ``tld`` with its dot, ``country_code``."""
    code = F.explode(F.split(F.lit(" ".join(COUNTRY_CODES.split())), " "))
    codes = spark.range(1, numPartitions=1).select(code.alias("country_code"))
    suffixes = F.array(F.lower("country_code"))
    for tld, owner in SECOND_SUFFIXES.items():
        second = F.when(F.col("country_code") == owner, F.array(F.lit(tld[1:])))
        suffixes = F.concat(suffixes, F.coalesce(second, F.array().cast("array<string>")))
    tlds = codes.select(F.explode(suffixes).alias("label"), "country_code")
    return tlds.select(F.concat(F.lit("."), "label").alias("tld"), "country_code")


def country_rows(lines: DataFrame, position: Column) -> DataFrame:
    """Suffix table from ``value`` lines of ``name,code,tld[; tld…]``.

    Code and suffixes are the last two fields, so a name with an unquoted comma
    does no harm. A suffix named twice belongs to its later row.
    """
    last_two = r"([^,]*),([^,]*)\z"

    def field(group: int) -> Column:
        raw = F.regexp_extract(F.rtrim("value"), last_two, group)
        return F.trim(F.trim(raw), F.lit('"'))

    fields = lines.select(
        position.alias("position"), field(1).alias("code"), field(2).alias("tlds"), "value"
    ).where((F.col("tlds") != "") & (F.lower(F.trim("value")) != "name,code,tld"))
    tlds = fields.select(
        "position", "code", F.posexplode(F.split("tlds", ";")).alias("nth", "raw_tld")
    )
    return tlds.groupBy(F.trim("raw_tld").alias("tld")).agg(
        F.max_by("code", F.struct("position", "nth")).alias("country_code")
    )


def read_country_tlds(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
    return country_rows(lines, F.struct(F.col("block"), F.monotonically_increasing_id()))


def ad_host_rows(lines: DataFrame) -> DataFrame:
    """Distinct lower-case hosts from ``value`` lines of a hosts file."""
    line = F.trim("value", F.lit(WHITESPACE))
    spaces = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"
    parts = F.split(line, spaces)
    named = lines.where((line != "") & ~line.startswith("#") & (F.size(parts) >= 2))
    return named.select(F.lower(F.element_at(parts, 2)).alias("host")).distinct()


def read_ad_hosts(spark: SparkSession, path: str) -> DataFrame:
    """Ad hosts of a hosts file; an empty table if there is no such file."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.AD_HOSTS)
    return ad_host_rows(lines)


def parse_category_reply(reply: Column) -> Column:
    """Category entries of a JSON reply; an empty array where it has none."""
    entries = F.from_json(reply, schemas.CATEGORY_REPLY).getField("categories")
    empty = F.array().cast(schemas.CATEGORIES)
    return F.coalesce(entries, empty)


def best_category(categories: Column) -> Column:
    """Name of the most confident entry; the first of equals; null if none."""
    ranked = F.transform(
        categories,
        lambda entry, nth: F.struct(
            entry["confidence"].alias("confidence"), (-nth).alias("earlier"), entry["name"].alias("name")
        ),
    )
    return F.array_max(ranked).getField("name")


def category_table(replies: DataFrame) -> DataFrame:
    """``domain, category`` from ``domain, categories``, one row a domain.

    Rows that repeat a domain are ranked together, so the join that follows can
    never multiply sites; it finds its side already spread by domain.
    """
    best = F.array_max(
        F.transform(
            "categories",
            lambda entry, nth: F.struct(entry["confidence"], -nth, entry["name"].alias("name")),
        )
    )
    ranked = replies.select(F.lower("domain").alias("domain"), best.alias("best"))
    return ranked.groupBy("domain").agg(F.max("best").getField("name").alias("category"))
