"""Sources and sinks: K1-K15."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.functions.parsing import gate_number
from stridelake.sources.shared import folder, stored


def snapshot(spark: SparkSession, sources: Mapping[str, str], out_dir: str, url: str, options: Mapping[str, str] | None = None, split: Mapping[str, tuple[str, int]] | None = None) -> dict[str, DataFrame]:
    """Read each named query by JDBC, write it as Parquet, and return frames that read the Parquet.

    So later work never goes back to the database. ``options`` go to the reader,
    for a driver or credentials. ``split`` names a column and a number of parts for
    a query, which is then read over so many connections; see ``split_read``.
    """
    out = {}
    for name, query in sources.items():
        if split and name in split:
            rows = split_read(spark, query, url, *split[name], options)
        else:
            rows = _jdbc(spark, url, options).option("query", query).load()
        save(rows, f"{out_dir}/{name}")
        out[name] = spark.read.parquet(f"{out_dir}/{name}")
    return out


def _jdbc(spark: SparkSession, url: str, options: Mapping[str, str] | None):
    return spark.read.format("jdbc").option("url", url).options(**(options or {}))


def split_read(spark: SparkSession, query: str, url: str, column: str, parts: int, options: Mapping[str, str] | None = None) -> DataFrame:
    """A query's rows over ``parts`` connections, each with a range of a column of numbers, dates or timestamps.

    One query in the database finds the least and the greatest value and how many
    rows there are; ranges between them are as wide as each other. A range that
    holds more than twice its share is cut again, counted in the database, so a
    few busy values do not leave one connection with all rows; a single value is
    never cut. Rows without a value go with the first range. No row is lost: the
    outer ranges are open.
    """
    inner = f"({query}) q"
    seen = _jdbc(spark, url, options).option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {inner}").load().head()
    low, high, total = seen[0], seen[1], int(seen[2])
    if low is None or low == high or parts < 2:
        return _jdbc(spark, url, options).option("dbtable", inner).load()
    borders = _between(low, high, parts)

    def sizes(cuts: list) -> list[int]:
        cases = " ".join(f"WHEN {column} < {_literal(c)} THEN {k}" for k, c in enumerate(cuts))
        counted = f"SELECT k, COUNT(*) AS n FROM (SELECT CASE {cases} ELSE {len(cuts)} END AS k FROM {inner} WHERE {column} IS NOT NULL) c GROUP BY k"
        found = {int(r[0]): int(r[1]) for r in _jdbc(spark, url, options).option("query", counted).load().collect()}  # a row a range
        return [found.get(k, 0) for k in range(len(cuts) + 1)]

    for _ in range(CUT_ROUNDS):
        counts, edges, more = sizes(borders), [low, *borders, high], []
        for k, n in enumerate(counts):
            if n * parts > 2 * total:
                more += _between(edges[k], edges[k + 1], 4)
        cut = sorted({*borders, *more})
        if cut == borders:
            break
        borders = cut
    ends = [None, *borders, None]
    wheres = []
    for a, b in zip(ends, ends[1:], strict=False):
        bounds = [f"{column} >= {_literal(a)}"] if a is not None else []
        bounds += [f"{column} < {_literal(b)}"] if b is not None else []
        wheres.append(" AND ".join(bounds) if a is not None else f"({bounds[0]} OR {column} IS NULL)")
    return spark.read.jdbc(url, inner, predicates=wheres, properties={"fetchsize": "10000", **(options or {})})


#: Times that a busy range of ``split_read`` is cut in four.
CUT_ROUNDS = 8


def _between(low, high, parts: int) -> list:
    """Values that cut a range in equal parts, without its ends; whole numbers and dates stay whole."""
    span = high - low
    if isinstance(low, dt.datetime):
        cuts = [low + span * k / parts for k in range(1, parts)]
    elif isinstance(low, dt.date):
        cuts = [low + dt.timedelta(days=span.days * k // parts) for k in range(1, parts)]
    elif isinstance(low, int):
        cuts = [low + span * k // parts for k in range(1, parts)]
    else:
        cuts = [low + span * k / parts for k in range(1, parts)]
    return sorted({c for c in cuts if low < c < high} | ({high} if isinstance(low, (int, dt.date)) and not isinstance(low, dt.datetime) else set()))


def _literal(value) -> str:
    """A value as SQL text, times in the form that every JDBC driver translates."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    return f"{{d '{value}'}}" if isinstance(value, dt.date) else str(value)


def load_tables(spark: SparkSession, folder: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The named Parquet tables of a folder, or all of them; those that are not there, or empty files, are left out."""
    if names is None:
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
        there = [(f.getPath().getName(), f.isFile() and not f.getLen()) for f in listed]
        names = sorted(n.removesuffix(".parquet") for n, empty in there if n.endswith(".parquet") and not empty)
    out = {}
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            out[name] = spark.read.parquet(f"{folder}/{name}.parquet")
    return out


def save(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write snappy Parquet; adaptive execution sizes the files."""
    df.write.mode(mode).option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (), policy: str = "update") -> DataFrame:
    """Base with a delta put in by key: ``update`` lets the delta win, ``nothing`` the base.

    Of several delta rows of a key the first by ``order`` counts.
    """
    rank = F.lit(0 if policy == "update" else 2)
    both = base.withColumn("__s", F.lit(1)).unionByName(delta.withColumn("__s", rank), allowMissingColumns=True)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("__s", *order))
    return both.withColumn("__n", first).filter("__n = 1").drop("__s", "__n")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that the frame holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


#: The partition column of tables that are kept in buckets.
BUCKET = "__bucket"


def save_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table as ``buckets`` partitions by the hash of its keys, for ``upsert_buckets``."""
    keyed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    save(keyed.repartition(BUCKET), path, [BUCKET])


def upsert_buckets(spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str], buckets: int, order: Sequence[str | Column] = (), policy: str = "update") -> list[int]:
    """Put a delta into a table of ``save_buckets``: only buckets that it hits are read, merged and swapped.

    Returns those buckets, at most ``buckets`` numbers. The files of all others stay
    as they are. Rows are as in ``upsert``; of several delta rows of a key the first
    by ``order`` counts. New files are written beside the old ones and take their
    place when all are there; a delta that is put in again changes nothing.
    """
    keyed = delta.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    hit = sorted(r[0] for r in keyed.select(BUCKET).distinct().collect())
    if hit:
        table = spark.read.parquet(path)
        # A partition column is read as an integer, but comes last.
        base = table.filter(F.col(BUCKET).isin(hit))
        merged = upsert(base, keyed, [BUCKET, *keys], order, policy).select(*table.columns)
        overwrite_partitions(merged.repartition(BUCKET), path, [BUCKET])
    return hit


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that is kept in buckets."""
    return spark.read.parquet(path).drop(BUCKET)


def unprocessed(candidates: DataFrame, ledger: DataFrame, key: str, tag: str) -> DataFrame:
    """Candidates that the ledger does not mark ``processed`` under a tag."""
    done = ledger.filter((F.col("message") == tag) & (F.col("status") == "processed")).select(key).distinct()
    return candidates.join(done, key, "left_anti")


def ledger_rows(done: DataFrame, key: str, tag: str, status: str = "processed") -> DataFrame:
    """Ledger rows for keys, to be put in by ``upsert`` on (key, message)."""
    return done.select(key).distinct().withColumns({"message": F.lit(tag), "status": F.lit(status)})


_STATS = "stats_data:struct<stat:array<struct<_type:string,starts:double,wins:double,places:double,shows:double,earnings:double,paid:double,roi:double>>>"
#: The fields of the cards, by their tags.
CARD_SCHEMA = f"""race_date string, track string, race int, breed_type string, post_time string, todays_cls int, distance double, dist_unit string, surface string, purse double,
country string, course_id string, stkorclm string, claimamt double, age_restr string, bet_opt string, raceord int, partim double, dist_disp string, race_text string, stk_clm_md string,
horsedata array<struct<_number:string,horse_name:string,program:string,morn_odds:string,weight:double,axciskey:string,{_STATS},
  workoutdata:array<struct<worknum:int,days_back:int,worktext:string,ranking:int,rank_group:int>>,
  jockey:struct<jock_key:string,jock_disp:string,j_type:string,stat_breed:string,{_STATS}>,
  trainer:struct<train_key:string,tran_disp:string,t_type:string,stat_breed:string,{_STATS}>,
  sire:struct<sirename:string,stat_breed:string,tmmark:string,stud_fee:string,{_STATS}>,
  dam:struct<damname:string,stat_breed:string,damsire:string,{_STATS}>>>"""
#: The children of a horse, and the field that is the key of each.
CARD_CHILDREN = {"jockey": "jock_key", "trainer": "train_key", "sire": "sirename", "dam": "damname"}


def read_xml_cards(spark: SparkSession, path: str, schema: str = CARD_SCHEMA, row_tag: str = "racedata", strict: bool = False) -> dict[str, DataFrame]:
    """Race cards as tables: races, horses, workouts, jockeys, trainers, sires, dams, and the stats of them all.

    With ``strict`` a card that cannot be read, or has a field that cannot, is in
    none of them but in ``rejects`` (file_name, reason, record), with files that
    hold no card. Each file is then read as one text and cut into its cards, as
    Spark's reader of XML gives the whole file for the record of each such card.

    Tags are read in lower case. A child without its key is left out; of a child
    that is named several times one row stays, that with the greatest fields. In
    ``stats`` a row is known by ``owner`` (horse, jockey, ...), ``owner_key`` and
    ``type``; figures that are not there are 0.

    Cards are parsed once and stored as Parquet in the shared folder, from which all
    tables are read.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if strict:
        whole = spark.read.text(path, wholetext=True)
        each = whole.select(F.col("_metadata.file_name").alias("__file"), F.col("value").cast("binary").alias("value")).mapInArrow(_cut(row_tag), "__file string, record string")
        parsed = F.from_xml("record", f"{schema}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
        marked = stored(each.select("__file", parsed.alias("r")).select("__file", "r.*"), folder(spark, "cards"))
        cards = marked.filter(F.col(BAD).isNull()).drop(BAD, "__file")
    else:
        cards = stored(reader.schema(schema).load(path), folder(spark, "cards"))
    races = cards.select(*(c for c in cards.columns if c != "horsedata"))
    key = ["track", "race_date", "race"]
    horses = cards.select(*key, F.explode("horsedata").alias("h")).select(*key, "h.*").withColumnRenamed("_number", "number")
    out = {"races": races}
    out["workouts"] = horses.select(*key, "program", F.explode("workoutdata").alias("w")).select(*key, "program", "w.*")
    nested = {"workoutdata", "stats_data"}
    children = {c: k for c, k in CARD_CHILDREN.items() if c in horses.columns}
    owners = {"horse": ("axciskey", "stats_data")} if {"axciskey", "stats_data"} <= {*horses.columns} else {}
    for child, child_key in children.items():
        fields = [f.name for f in horses.schema[child].dataType.fields if f.name not in ("stats_data", child_key)]
        named = horses.filter(F.col(f"{child}.{child_key}").isNotNull()).groupBy(F.col(f"{child}.{child_key}").alias(child_key))
        out[f"{child}s"] = named.agg(F.max(F.struct(*(F.col(f"{child}.{f}").alias(f) for f in fields))).alias("r")).select(child_key, "r.*")
        owners[child] = (f"{child}.{child_key}", f"{child}.stats_data")
    if owners:
        each = F.array(*(F.struct(F.lit(owner).alias("owner"), F.col(k).alias("owner_key"), F.col(f"{listed}.stat").alias("stats")) for owner, (k, listed) in owners.items()))
        stats = horses.select(F.explode(each).alias("o")).select("o.owner", "o.owner_key", F.explode("o.stats").alias("s")).filter("owner_key is not null and s._type is not null")
        figures = ("starts", "wins", "places", "shows", "earnings", "paid", "roi")
        largest = stats.groupBy("owner", "owner_key", F.col("s._type").alias("type")).agg(F.max(F.struct(*(F.coalesce(F.col(f"s.{f}"), F.lit(0.0)).alias(f) for f in figures))).alias("r"))
        out["stats"] = largest.select("owner", "owner_key", "type", "r.*")
    out["horses"] = horses.drop(*nested, *children)
    if strict:
        bad = marked.filter(F.col(BAD).isNotNull()).select(F.col("__file").alias("file_name"), F.lit("malformed").alias("reason"), F.substring(BAD, 1, RECORD_CHARS).alias("record"))
        out["rejects"] = bad.unionByName(_without_rows(spark, whole, marked.select(F.col("__file").alias("file_name"))))
    return out


#: The column in which readers put what they cannot read, and how much of it a reject shows.
BAD, RECORD_CHARS = "__bad", 2000


def cut_records(text: bytes, row_tag: str) -> Iterator[bytes]:
    """The elements of a tag in a text, outermost ones, in their order; tags in comments and CDATA are none.

    One without its end reaches to the end of the text, and so does a comment
    without one outside of them, so that a parser finds what is wrong with it. An
    end without its beginning is passed over.
    """
    tag = re.escape(row_tag.encode())
    token = rb"<!--.*?(-->|\Z)|<!\[CDATA\[.*?(\]\]>|\Z)|<(/?)" + tag + rb"(?=[\s/>])(?:(?:[^<>'\"]|'[^'<]*'|\"[^\"<]*\")*>|[^>]*>?)"
    begin, depth = 0, 0
    for m in re.finditer(token, text, re.S):
        if m[3] is None:
            if not depth and not (m[1] or m[2]):
                yield m[0]
        elif m[3]:
            if depth == 1:
                yield text[begin : m.end()]
            depth = max(depth - 1, 0)
        elif not m[0].endswith(b"/>"):
            begin = begin if depth else m.start()
            depth += 1
        elif not depth:
            yield m[0]
    if depth:
        yield text[begin:]


def _cut(row_tag: str):
    """A task: files as one text each, to their records."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column("__file").to_pylist(), batch.column("value"), strict=True):
                records = [r.decode("utf-8", "replace") for r in cut_records(text.as_py() or b"", row_tag)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(records), pa.string()), pa.array(records, pa.string())], names=["__file", "record"])

    return task


def _without_rows(spark: SparkSession, read: DataFrame, seen: DataFrame) -> DataFrame:
    """Rejects for the files of a reader that gave no row, empty ones among them."""
    names = [(unquote(f.rsplit("/", 1)[-1]),) for f in read.inputFiles()]  # the listing that Spark's driver holds anyway
    silent = spark.createDataFrame(names, "file_name string").join(seen.distinct(), "file_name", "left_anti")
    return silent.select("file_name", F.lit("no rows").alias("reason"), F.lit(None).cast("string").alias("record"))


WAGER_SCHEMA = "_NUMBER int, EXOTIC_WAGERS struct<WAGER:array<struct<_NUMBER:int,WAGER_TYPE:string,NUM_TICKETS:double,POOL_TOTAL:double,WINNERS:string,PAYOFF:double>>>"


def read_exotic_wagers(spark: SparkSession, path: str) -> DataFrame:
    """Exotic wagers of result charts, one row each."""
    charts = spark.read.format("xml").option("rowTag", "RACE").schema(WAGER_SCHEMA).load(path)
    rows = charts.select(F.col("_NUMBER").alias("race_number"), F.explode("EXOTIC_WAGERS.WAGER").alias("w")).select("race_number", "w.*")
    return rows.toDF("race_number", "wager_number", "wager_type", "num_tickets", "pool_total", "winners", "payoff")


GATE_FEED = "I string, G string, L double, S double, R double, B double, D double, N double"
GPS_FEED = "I string, T string, X double, Y double, V double, P double, SF double"


def read_json_feed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Gate or GPS feeds, one JSON array a file, with the file's name. Files that are no JSON give a row of nulls."""
    feed = spark.read.schema(GATE_FEED if kind == "gates" else GPS_FEED).option("multiLine", True).json(path).withColumn("file_name", F.col("_metadata.file_name"))
    return _feed_columns(feed, kind)


def _feed_columns(feed: DataFrame, kind: str) -> DataFrame:
    if kind == "gates":
        return feed.select(
            "file_name", F.col("I").alias("id"), F.col("G").alias("gate_name"), gate_number(F.col("G")).alias("gate_numeric"), F.col("L").alias("length_to_finish"),
            F.col("S").alias("sectional_time"), F.col("R").alias("running_time"), F.col("B").alias("distance_back"), F.col("D").alias("distance_ran"), F.col("N").alias("number_of_strides"),
        )
    return feed.select(
        "file_name", F.col("I").alias("id"), F.try_to_timestamp("T").alias("time_stamp"), F.col("X").alias("longitude"), F.col("Y").alias("latitude"),
        F.col("V").alias("speed"), F.col("P").alias("progress"), F.col("SF").alias("stride_frequency"),
    )


def read_json_feed_checked(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Like ``read_json_feed``, and the rejects: file_name, reason, record.

    Rejected are files that are no JSON array (``no array``), records that are no
    object or have a field that cannot be read (``malformed``), records without an
    id (``no id``), and files without a record (``no rows``). The other records of a
    file are good. Each file is read as one text.
    """
    files = spark.read.text(path, wholetext=True)
    named = files.select(F.col("_metadata.file_name").alias("file_name"), "value", F.from_json("value", "array<string>").alias("records"))
    each = named.select("file_name", "value", F.col("records").isNull().alias("broken"), F.explode_outer("records").alias("record"))
    schema = GATE_FEED if kind == "gates" else GPS_FEED
    parsed = each.withColumn("r", F.from_json("record", f"{schema}, {BAD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    empty = F.col("record").isNull() & ~F.col("broken")
    reason = (
        F.when(F.col("broken"), "no array").when(empty, "no rows").when(F.col(f"r.{BAD}").isNotNull() | ~F.trim("record").startswith("{"), "malformed").when(F.col("r.I").isNull(), "no id")
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.filter("reason is null").select("r.*", "file_name")
    bad = judged.filter("reason is not null").select("file_name", "reason", F.substring(F.when(F.col("broken"), F.col("value")).otherwise(F.col("record")), 1, RECORD_CHARS).alias("record"))
    return _feed_columns(good, kind), bad.unionByName(_without_rows(spark, files, named.select("file_name")))


def parse_feed_name(df: DataFrame, col: str, since: str | None = None) -> DataFrame:
    """Course code, date and post time of feed names such as AB202401021530; other names and earlier dates go."""
    pattern = r"^([A-Z0-9]{2})(\d{8})(\d{2})(\d{2})$"
    part = lambda i: F.regexp_extract(col, pattern, i)
    out = df.filter(F.col(col).rlike(pattern)).withColumns({
        "course_code": part(1), "race_date": F.try_to_timestamp(part(2), F.lit("yyyyMMdd")).cast("date"), "post_time": F.concat_ws(":", part(3), part(4)),
    })
    out = out.filter(F.col("race_date").isNotNull())
    return out if since is None else out.filter(F.col("race_date") >= F.lit(since).cast("date"))


def number_races(df: DataFrame, card: Sequence[str], post_time: str, tie: Sequence[str] = ()) -> DataFrame:
    """Race numbers from the order of post times within a card."""
    return df.withColumn("race_number", F.row_number().over(Window.partitionBy(*card).orderBy(post_time, *tie)))


def map_codes(df: DataFrame, col: str, mapping: Mapping[str, str], default: str = "UNK", drop: Sequence[str] = ("UNK", "XXX"), out: str | None = None) -> DataFrame:
    """Codes through a configured dictionary, held in the plan as a map; rows of dropped codes go."""
    pairs = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    mapped = df.withColumn(out or col, F.coalesce(F.element_at(pairs, F.trim(F.upper(F.col(col)))), F.lit(default)))
    return mapped.filter(~F.col(out or col).isin(list(drop)))


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of those that they break."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda x: x.isNotNull())
    marked = df.withColumn("reject_reason", F.array_join(broken, "; "))
    return marked.filter("reject_reason = ''").drop("reject_reason"), marked.filter("reject_reason <> ''")


RACE_LIST = "map<string,struct<I:string,RaceNo:int,PostTime:string,Country:string,Racecourse:string,RaceType:string,RaceLength:string,Published:string,EQBRacecourse:string>>"


def parse_race_list(df: DataFrame, col: str) -> DataFrame:
    """Race lists, JSON objects by race id, one row a race."""
    races = df.select(F.explode(F.from_json(col, RACE_LIST)).alias("race_key", "r"))
    return races.select("race_key", F.col("r.RaceNo").alias("race_number"), F.col("r.PostTime").alias("post_time"), F.col("r.Country").alias("country"), F.col("r.Racecourse").alias("racecourse"), F.col("r.RaceType").alias("race_type"), F.col("r.RaceLength").alias("race_length"), F.col("r.EQBRacecourse").alias("course_cd"))


def read_race_list(spark: SparkSession, path: str) -> DataFrame:
    """Race-list files, one JSON object each."""
    return parse_race_list(spark.read.text(path, wholetext=True), "value")


def parse_coordinates(text: Column) -> Column:
    """``lon,lat[,alt]`` triples as an array of (lon, lat)."""
    triples = F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")
    return F.transform(triples, lambda t: F.struct(F.get(F.split(t, ","), F.lit(0)).try_cast("double").alias("lon"), F.get(F.split(t, ","), F.lit(1)).try_cast("double").alias("lat")))


def read_routes(spark: SparkSession, path: str, codes: Mapping[str, str] | None = None) -> DataFrame:
    """Route lines of KML files: file_name, course_cd, name, line_type, line.

    Only placemarks named as a running or winning line are routes; rails, poles and
    the like are left out, and so are placemarks of several lines. The last two
    characters of a file's stem are its course; with ``codes`` they are translated,
    and files of a course that is not among them are left out. Of a course and
    type that come several times one row stays, that of the last file by name.
    """
    marks = spark.read.format("xml").option("rowTag", "Placemark").schema("name string, LineString struct<coordinates:string>").load(path)
    named = F.upper("name")
    kind = F.when(named.contains("RUNNING_LINE"), "RUNNING_LINE").when(named.contains("WINNING_LINE"), "WINNING_LINE")
    stem = F.regexp_extract("file_name", r"^([^.]*)", 1)
    rows = marks.select(F.col("_metadata.file_name").alias("file_name"), "name", kind.alias("line_type"), F.col("LineString.coordinates").alias("text"))
    rows = rows.filter("line_type is not null and text is not null").withColumn("course_cd", F.upper(F.substring(stem, -2, 2)))
    if codes is not None:
        rows = map_codes(rows, "course_cd", codes)
    last = rows.groupBy("course_cd", "line_type").agg(F.max(F.struct("file_name", "name", "text")).alias("r"))
    return last.select("r.file_name", "course_cd", "r.name", "line_type", parse_coordinates(F.col("r.text")).alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, for bet sheets."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a stated schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def append_history(df: DataFrame, path: str) -> None:
    """Add rows to a history table."""
    df.write.mode("append").option("compression", "snappy").parquet(path)
