"""Queries of sources and sinks. Files are written from the given tables and read back."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from stridelake.operators.sets import union_by_name
from stridelake.sources import tables as K
from stridelake.sources.shared import folder
from stridelake.plans.roles import RUNNERS, Group, runners, table

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R = f"WITH {RUNNERS}"


def write_files(rows, at: str, key, value, begin: str, between: str, end: str) -> None:
    """One text file for each value of the key, which is a bounded share of the rows."""
    files = rows.select(key.alias("f"), value.alias("v")).groupBy("f").agg(F.concat(F.lit(begin), F.array_join(F.array_sort(F.collect_list("v")), between), F.lit(end)).alias("value"))
    files.repartition("f").write.partitionBy("f").text(at)


def write_lines(rows, at: str, begin: str, value, end: str, packed: bool = False) -> None:
    """Text files of a line for each row, between two lines of their own; as large as Spark deals rows out, so that their number grows with bytes and not with keys.

    ``packed`` files are gzipped, and each task writes the rows that it has, so lines are never shuffled.
    """

    def framed(batches):
        kind = None
        for batch in filter(len, batches):
            if kind is None:
                kind = batch.schema
                yield pa.RecordBatch.from_arrays([pa.array([begin])], schema=kind)
            yield batch
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.array([end])], schema=kind)

    lines = rows.select(value.alias("value"))
    lines = lines if packed else lines.hint("rebalance")
    lines.mapInArrow(framed, "value string").write.mode("append").option("compression", "gzip" if packed else "none").text(at)


@add("k2_load_tables", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier")
def _(spark, d):
    found = K.load_tables(spark, d, ["nation", "supplier", "no_such_table"])
    return union_by_name(*(f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, f in found.items()))


@add("k3_save_partitioned", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(spark, d):
    at = folder(spark, "k3")
    K.save(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), at, ["o_orderpriority"])
    return spark.read.parquet(at).filter("o_orderpriority = '1-URGENT'")


@add("k4_upsert", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    delta = o.filter("o_orderkey % 3 = 0").withColumn("price", F.lit(-1.0))
    return K.upsert(o.filter("o_orderkey % 2 = 0"), delta, ["o_orderkey"], ["price"])


@add("k4_upsert_buckets", "SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 0 THEN -1.0 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 1000 = 0")
def _(spark, d):
    """A small delta that is put into the buckets that it hits."""
    at = folder(spark, "k4b")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    K.save_buckets(o.filter("o_orderkey % 2 = 0"), at, ["o_orderkey"], 32)
    K.upsert_buckets(spark, at, o.filter("o_orderkey % 1000 = 0").withColumn("price", F.lit(-1.0)), ["o_orderkey"], 32, ["price"])
    return K.read_buckets(spark, at)


@add("k4_insert_only", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE -1.0 END AS price FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    delta = o.filter("o_orderkey % 3 = 0").withColumn("price", F.lit(-1.0))
    return K.upsert(o.filter("o_orderkey % 2 = 0"), delta, ["o_orderkey"], ["price"], policy="nothing")


@add("k4_overwrite_partitions", "SELECT s_nationkey % 4 AS part, count(*) AS n, round(sum(CASE WHEN s_nationkey % 4 = 1 THEN 0 ELSE s_acctbal END), 4) AS total FROM supplier GROUP BY 1")
def _(spark, d):
    at = folder(spark, "k4")
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal", (F.col("s_nationkey") % 4).alias("part"))
    K.save(s, at, ["part"])
    K.overwrite_partitions(s.filter("part = 1").withColumn("s_acctbal", F.lit(0.0)), at, ["part"])
    return spark.read.parquet(at).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 4).alias("total"))


@add("k5_unprocessed", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')")
def _(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    ledger = K.ledger_rows(days.filter("o_orderstatus = 'P'"), "day", "stats")
    return K.unprocessed(days.select("day").distinct(), ledger, "day", "stats")


@add("k6_xml_cards", R + " SELECT track, CAST(race AS INTEGER) AS race, CAST(num AS VARCHAR) AS program, CAST(horse AS VARCHAR) AS horse_name, num % 3 AS workouts FROM runners")
def _(spark, d):
    work = F.array_join(F.transform(F.sequence(F.lit(0), F.col("num") % 3), lambda i: F.when(i > 0, F.concat(F.lit("<WORKOUTDATA><WORKNUM>"), i.cast("string"), F.lit("</WORKNUM><DAYS_BACK>7</DAYS_BACK></WORKOUTDATA>")))), "")
    horse = F.concat(F.lit('<HORSEDATA number="'), F.col("num").cast("string"), F.lit('"><HORSE_NAME>'), F.col("horse").cast("string"), F.lit("</HORSE_NAME><PROGRAM>"), F.col("num").cast("string"), F.lit("</PROGRAM>"), work, F.lit("</HORSEDATA>"))
    races = runners(spark, d).groupBy("race", "track", "race_date").agg(F.array_join(F.array_sort(F.collect_list(horse)), "").alias("h"))
    card = F.concat(F.lit("<RACEDATA><RACE_DATE>"), F.date_format("race_date", "yyyyMMdd"), F.lit("</RACE_DATE><TRACK>"), "track", F.lit("</TRACK><RACE>"), F.col("race").cast("string"), F.lit("</RACE>"), "h", F.lit("</RACEDATA>"))
    at = folder(spark, "k6")
    write_lines(races, at, "<cards>", F.lower(card), "</cards>")
    got = K.read_xml_cards(spark, at)
    key = ["track", "race", "program"]
    counts = got["workouts"].groupBy(*key).agg(F.count(F.lit(1)).alias("workouts"))
    joined = got["horses"].select(*key, "horse_name").join(counts, key, "left")
    return joined.select(F.upper("track").alias("track"), "race", "program", "horse_name", F.coalesce("workouts", F.lit(0)).cast("int").alias("workouts"))


@add("k6_card_children", R + """ SELECT 'jockey' AS owner, CAST(jockey AS VARCHAR) AS owner_key, 'LIFE' AS type, max(num)::DOUBLE AS starts, 'J' || jockey AS shown FROM runners GROUP BY jockey
  UNION ALL SELECT 'trainer', CAST(trainer AS VARCHAR), 'YEAR', max(num)::DOUBLE, 'T' || trainer FROM runners GROUP BY trainer
  UNION ALL SELECT 'sire', 'S' || (horse % 50), 'LIFE', 0.0, 'KY' FROM runners GROUP BY horse % 50""")  # fmt: skip
def _(spark, d):
    text = lambda tag, v: F.concat(F.lit(f"<{tag}>"), F.col(v).cast("string") if isinstance(v, str) else v.cast("string"), F.lit(f"</{tag}>"))
    stat = lambda kind, inner: F.concat(F.lit(f'<STATS_DATA><STAT type="{kind}">'), inner, F.lit("</STAT></STATS_DATA>"))

    def horse(r):
        jockey = text("JOCKEY", F.concat(text("JOCK_KEY", r["jockey"]), text("JOCK_DISP", F.concat(F.lit("J"), r["jockey"].cast("string"))), stat("LIFE", text("STARTS", r["num"]))))
        trainer = text("TRAINER", F.concat(text("TRAIN_KEY", r["trainer"]), text("TRAN_DISP", F.concat(F.lit("T"), r["trainer"].cast("string"))), stat("YEAR", text("STARTS", r["num"]))))
        sire = text("SIRE", F.concat(text("SIRENAME", F.concat(F.lit("S"), (r["horse"] % 50).cast("string"))), text("STAT_BREED", F.lit("KY")), stat("LIFE", F.lit(""))))
        return text("HORSEDATA", F.concat(text("PROGRAM", r["num"]), jockey, trainer, sire))

    # Numbers are gathered and not their tags, which are many times as long.
    races = runners(spark, d).groupBy("race", "track", "race_date").agg(F.collect_list(F.struct("num", "jockey", "trainer", "horse")).alias("r"))
    races = races.withColumn("h", F.array_join(F.array_sort(F.transform("r", horse)), ""))
    card = text("RACEDATA", F.concat(text("TRACK", "track"), text("RACE", "race"), F.col("h")))
    at = folder(spark, "k6c")
    write_lines(races, at, "<cards>", F.lower(card), "</cards>", packed=True)
    got = K.read_xml_cards(spark, at)
    names = got["jockeys"].select(F.lit("jockey").alias("owner"), F.col("jock_key").alias("owner_key"), F.upper("jock_disp").alias("shown"))
    names = names.unionByName(got["trainers"].select(F.lit("trainer").alias("owner"), F.col("train_key").alias("owner_key"), F.upper("tran_disp").alias("shown")))
    names = names.unionByName(got["sires"].select(F.lit("sire").alias("owner"), F.upper("sirename").alias("owner_key"), F.upper("stat_breed").alias("shown")))
    stats = got["stats"].select("owner", F.upper("owner_key").alias("owner_key"), F.upper("type").alias("type"), "starts")
    return stats.join(names, ["owner", "owner_key"])


@add("k6_exotic_wagers", R + " SELECT CAST(race AS INTEGER) AS race_number, 1 AS wager_number, 'Exacta' AS wager_type, string_agg(CAST(num AS VARCHAR), '-' ORDER BY finish) AS winners FROM runners WHERE finish <= 2 GROUP BY race")
def _(spark, d):
    won = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("finish", "num"))), lambda x: x["num"].cast("string")), "-")
    races = runners(spark, d).filter("finish <= 2").groupBy("race").agg(won.alias("w"))
    xml = F.concat(F.lit('<RACE NUMBER="'), F.col("race").cast("string"), F.lit('"><EXOTIC_WAGERS><WAGER NUMBER="1"><WAGER_TYPE>Exacta</WAGER_TYPE><WINNERS>'), "w", F.lit("</WINNERS><PAYOFF>12.5</PAYOFF></WAGER></EXOTIC_WAGERS></RACE>"))
    at = folder(spark, "k6w")
    write_lines(races, at, "<chart>", xml, "</chart>")
    return K.read_exotic_wagers(spark, at).select("race_number", "wager_number", "wager_type", "winners")


@add("k7_json_gates", "SELECT CAST(event_id AS VARCHAR) AS id, (event_id % 9)::DOUBLE AS gate_numeric, value AS sectional_time FROM events")
def _(spark, d):
    at = folder(spark, "k7")
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("I"), F.concat((F.col("event_id") % 9).cast("string"), F.lit("f")).alias("G"), F.col("value").alias("S"))
    write_files(e, at, F.floor(F.col("I").cast("long") / 500), F.to_json(F.struct("I", "G", "S")), "[", ",", "]")
    return K.read_json_feed(spark, at, "gates").select("id", "gate_numeric", "sectional_time")


@add("k7_json_gps", "SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(date_trunc('second', ts)) AS us, value AS speed FROM events")
def _(spark, d):
    from stridelake.functions.clock import micros

    at = folder(spark, "k7g")
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("I"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("T"), F.col("value").alias("V"))
    write_files(e, at, F.floor(F.col("I").cast("long") / 500), F.to_json(F.struct("I", "T", "V")), "[", ",", "]")
    return K.read_json_feed(spark, at, "gps").select("id", micros("time_stamp").alias("us"), "speed")


@add("k8_feed_names", "SELECT event_id, 'AB' AS course_code, CAST(ts AS DATE) AS race_date, strftime(ts, '%H:%M') AS post_time FROM events WHERE event_id % 4 <> 0 AND ts >= TIMESTAMP '2024-01-10'")
def _(spark, d):
    name = F.when(F.col("event_id") % 4 == 0, "notes.txt").otherwise(F.concat(F.lit("AB"), F.date_format("ts", "yyyyMMddHHmm")))
    return K.parse_feed_name(table(spark, d, "events").select("event_id", name.alias("name")), "name", "2024-01-10").drop("name")


@add("k9_number_races", "SELECT event_id, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS race_number FROM events")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "ts", F.to_date("ts").alias("day"))
    return K.number_races(e, ["event_type", "day"], "ts", ["event_id"]).select("event_id", F.col("race_number").cast("long").alias("race_number"))


@add("k10_map_codes", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'BLD' WHEN 'MACHINERY' THEN 'MCH' ELSE 'AUT' END AS code FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')")
def _(spark, d):
    return K.map_codes(table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("code")), "code", {"BUILDING": "BLD", "MACHINERY": "MCH", "AUTOMOBILE": "AUT", "FURNITURE": "XXX"})


@add("k11_split_rejects", "SELECT event_id, CASE WHEN value >= 50 AND event_type = 'error' THEN 'high; error' WHEN value >= 50 THEN 'high' ELSE 'error' END AS reject_reason FROM events WHERE value >= 50 OR event_type = 'error'")
def _(spark, d):
    _, bad = K.split_rejects(table(spark, d, "events"), {"high": F.col("value") < 50, "error": F.col("event_type") != "error"})
    return bad.select("event_id", "reject_reason")


@add("k12_race_list", "SELECT CAST(o_orderkey AS VARCHAR) AS race_key, CAST(o_orderkey % 12 AS INTEGER) AS race_number, o_orderpriority AS racecourse FROM orders")
def _(spark, d):
    at = folder(spark, "k12")
    one = F.to_json(F.struct((F.col("o_orderkey") % 12).cast("int").alias("RaceNo"), F.col("o_orderpriority").alias("Racecourse")))
    entry = F.concat(F.lit('"'), F.col("o_orderkey").cast("string"), F.lit('":'), one)
    write_files(table(spark, d, "orders"), at, F.floor(F.col("o_orderkey") / 500), entry, "{", ",", "}")
    return K.read_race_list(spark, at).select("race_key", "race_number", "racecourse")


def named_files(spark, rows, at: str, ending: str) -> None:
    """One text file for each row of (f, value), named by f; a few hundred rows."""
    rows.repartition("f").write.partitionBy("f").text(f"{at}-parts")
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    files = path(at).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(at))
    for found in files.globStatus(path(f"{at}-parts/f=*/part-*")):
        files.rename(found.getPath(), path(f"{at}/{found.getPath().getParent().getName()[2:]}.{ending}"))


_COURSE = "chr(CAST(65 + b // 10 AS INTEGER)) || chr(CAST(65 + b % 10 AS INTEGER))"


@add("k13_routes", f"""WITH c AS (SELECT c_custkey % 100 AS b, max(c_custkey) AS top FROM customer GROUP BY 1), k AS (SELECT {_COURSE} AS course_cd, b, top FROM c)
  SELECT course_cd, 'RUNNING_LINE' AS line_type, 2 AS n, top * 0.5::DOUBLE AS last_lat FROM k UNION ALL SELECT course_cd, 'WINNING_LINE', 3, -top * 0.5::DOUBLE FROM k WHERE b % 2 = 0""")  # fmt: skip
def _(spark, d):
    """A file a course, with a rail fence and a pole that are no routes."""
    c = table(spark, d, "customer").groupBy((F.col("c_custkey") % 100).alias("b")).agg(F.max("c_custkey").alias("top"))
    lat = (F.col("top") * 0.5).cast("string")
    mark = lambda name, coordinates: F.concat(F.lit(f"<Placemark><name>{name}</name><LineString><coordinates>"), *coordinates, F.lit("</coordinates></LineString></Placemark>"))
    running = mark("main running_line", [F.lit(" -84.5,38.0,0 -84.4,"), lat, F.lit(",0 ")])
    winning = F.when(F.col("b") % 2 == 0, mark("WINNING_LINE", [F.lit("-84.5,38.0 -84.5,39.0 -84.4,-"), lat])).otherwise("")
    fence = mark("RAIL_FENCE", [F.lit("0,0 1,1")])
    pole = F.lit("<Placemark><name>Winning post</name><Point><coordinates>1,1</coordinates></Point></Placemark>")
    code = F.concat(F.char((65 + F.floor(F.col("b") / 10)).cast("int")), F.char((65 + F.col("b") % 10).cast("int")))
    at = folder(spark, "k13")
    named_files(spark, c.select(F.concat(F.lit("routes_"), code).alias("f"), F.concat(F.lit("<kml>"), fence, running, pole, winning, F.lit("</kml>")).alias("value")), at, "kml")
    got = K.read_routes(spark, at)
    return got.select("course_cd", "line_type", F.size("line").alias("n"), F.element_at("line", -1)["lat"].alias("last_lat"))


@add("k7_rejects", """SELECT CASE WHEN event_id % 500 = 7 AND event_id // 500 % 3 <> 1 THEN 'malformed' WHEN event_id % 500 = 8 AND event_id // 500 % 3 <> 1 THEN 'no id' ELSE 'good' END AS side, count(*) AS n, round(sum(CASE WHEN event_id % 500 IN (7, 8) THEN 0 ELSE value END), 4) AS total
  FROM events WHERE event_id // 500 % 3 <> 1 GROUP BY 1 UNION ALL SELECT 'no array', count(DISTINCT event_id // 500), 0 FROM events WHERE event_id // 500 % 3 = 1""")  # fmt: skip
def _(spark, d):
    """Feeds of which every third file is cut off, and two records of each other file are not what they should be."""
    at = folder(spark, "k7r")
    e = table(spark, d, "events").select((F.col("event_id") % 500).alias("k"), F.floor(F.col("event_id") / 500).alias("f"), F.col("event_id").cast("string").alias("I"), F.col("value").alias("S"))
    whole = F.to_json(F.struct("I", "S"))
    record = F.when(F.col("k") == 7, F.concat(F.lit('{"I":"'), "I", F.lit('","S":"fast"}'))).when(F.col("k") == 8, F.to_json(F.struct("S"))).otherwise(whole)
    files = e.groupBy("f").agg(F.array_join(F.sort_array(F.collect_list(record)), ",").alias("v"))
    end = F.when(F.col("f") % 3 == 1, ',{"I":').otherwise("]")
    files.select(F.concat(F.lit("["), "v", end).alias("value"), "f").repartition("f").write.partitionBy("f").text(at)
    good, bad = K.read_json_feed_checked(spark, at, "gates")
    one = good.agg(F.lit("good").alias("side"), F.count(F.lit(1)).alias("n"), F.round(F.sum("sectional_time"), 4).alias("total"))
    return one.unionByName(bad.groupBy(F.col("reason").alias("side")).agg(F.count(F.lit(1)).alias("n"), F.lit(0.0).alias("total")))


@add("k6_rejects", """SELECT 'races' AS side, count(*) AS n FROM orders WHERE o_orderkey % 10 NOT IN (3, 4) UNION ALL SELECT 'malformed', count(*) FROM orders WHERE o_orderkey % 10 IN (3, 4)
  UNION ALL SELECT 'no rows', 1""")  # fmt: skip
def _(spark, d):
    """Cards of which a tenth have a race number that is none, a tenth tags that do not match, and one file holds no card."""
    at = folder(spark, "k6r")
    key = F.col("o_orderkey").cast("string")
    number = F.when(F.col("o_orderkey") % 10 == 3, "first").otherwise(key)
    end = F.when(F.col("o_orderkey") % 10 == 4, "</race></track>").otherwise("</track>")
    card = F.concat(F.lit("<racedata><race>"), number, F.lit("</race><track>"), "o_orderpriority", end, F.lit("</racedata>"))
    write_files(table(spark, d, "orders"), at, F.floor(F.col("o_orderkey") / 2000), card, "<cards>", "", "</cards>")
    spark.range(1).select(F.lit("<cards></cards>").alias("value")).coalesce(1).write.text(f"{at}/f=-1")
    got = K.read_xml_cards(spark, at, strict=True)
    races = got["races"].agg(F.lit("races").alias("side"), F.count(F.lit(1)).alias("n"))
    return races.unionByName(got["rejects"].groupBy(F.col("reason").alias("side")).agg(F.count(F.lit(1)).alias("n")))


@add("k1_split_read", "SELECT o_orderkey AS id, o_orderpriority AS priority, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 7 ELSE o_custkey END AS customer FROM orders")
def _(spark, d):
    """Orders from a database over several connections, split by a column of which most rows are one value or null."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    busy = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).when(F.col("o_orderkey") % 2 == 0, 7).otherwise(F.col("o_custkey"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ID"), F.col("o_orderpriority").alias("PRIORITY"), busy.cast("long").alias("CUSTOMER"))
    o.write.format("jdbc").option("url", url).option("dbtable", "ORDERS").option("createTableColumnTypes", "PRIORITY VARCHAR(64)").mode("append").save()
    got = K.snapshot(spark, {"orders": "SELECT ID, PRIORITY, CUSTOMER FROM ORDERS"}, folder(spark, "k1s"), url, split={"orders": ("CUSTOMER", 4)})
    return got["orders"].toDF("id", "priority", "customer")


@add("k14_csv_sheets", R + " SELECT race, num, odds FROM runners WHERE finish = 1")
def _(spark, d):
    at = folder(spark, "k14")
    K.write_csv(runners(spark, d).filter("finish = 1").select("race", "num", "odds"), at)
    return K.read_csv(spark, at, "race long, num int, odds double")


@add("k15_append_history", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def _(spark, d):
    at = folder(spark, "k15")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("P", "F", "O"):
        K.append_history(o.filter(F.col("o_orderstatus") == status), at)
    return spark.read.parquet(at).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@add("k1_snapshot", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def _(spark, d):
    """JDBC needs a database and its driver: the one on Spark's own class path is Derby, filled from the given table."""
    name = uuid.uuid4().hex
    url = f"jdbc:derby:memory:{name};create=true"
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("ID"), F.col("n_name").alias("NAME"))
    n.write.format("jdbc").option("url", url).option("dbtable", "NATION").option("createTableColumnTypes", "NAME VARCHAR(64)").mode("append").save()
    return K.snapshot(spark, {"nation": "SELECT ID, NAME FROM NATION"}, folder(spark, "k1"), url)["nation"].toDF("id", "name")
