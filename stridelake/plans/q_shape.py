"""Queries of projection, parsing, sets and order."""

from __future__ import annotations


from pyspark.sql import functions as F

from stridelake.functions import parsing as fn
from stridelake.functions.clock import micros
from stridelake.operators import sets, shaping
from stridelake.plans.roles import POINTS, RUNNERS, Group, points, runners, table

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R, P = f"WITH {RUNNERS}", f"WITH {POINTS}"


@add("p1_normalize_keys", "SELECT c_custkey, upper(trim(c_mktsegment)) AS c_mktsegment, CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer")
def _(spark, d):
    lower = table(spark, d, "customer").select("c_custkey", F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  ")).alias("c_mktsegment"), F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return shaping.normalize_keys(lower, ["c_mktsegment"], ["c_nationkey"])


@add("p2_conform", "SELECT p_partkey, trim(p_name) AS p_name, TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS p_brand, CAST(p_size AS DOUBLE) AS p_size FROM part")
def _(spark, d):
    raw = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit("  ")).alias("p_name"), F.regexp_replace("p_brand", "Brand#", "").alias("p_brand"), "p_size")
    return shaping.conform(raw, {"p_brand": "int", "p_size": "double", "absent": "date"})


@add("p3_decimals_to_double", "SELECT s_suppkey, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS s_acctbal FROM supplier")
def _(spark, d):
    return shaping.decimals_to_double(table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").cast("decimal(12,2)").alias("s_acctbal")))


@add("p4_distance_meters", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN round(p_size / 100.0::DOUBLE * 201.168) WHEN 1 THEN round(p_size::DOUBLE) WHEN 2 THEN round(p_size * 0.9144::DOUBLE) END AS metres FROM part")
def _(spark, d):
    unit = F.element_at(F.array(F.lit("F"), F.lit("M"), F.lit("Y"), F.lit("Q")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", fn.distance_meters(F.col("p_size"), unit).alias("metres"))


@add("p5_format_timestamps", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def _(spark, d):
    return shaping.format_timestamps(table(spark, d, "events").select("event_id", "ts"))


@add("p6_race_id", R + " SELECT race, num, track || '_' || strftime(race_date, '%Y-%m-%d') || '_' || num AS plain, track || '_' || strftime(race_date, '%Y-%m-%d') || '_' || lpad(CAST(num AS VARCHAR), 2, '0') AS padded FROM runners")
def _(spark, d):
    r = runners(spark, d)
    args = (F.col("track"), F.col("race_date"), F.col("num"))
    return r.select("race", "num", fn.race_id(*args).alias("plain"), fn.race_id(*args, pad=True).alias("padded"))


@add("p7_keep_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, d):
    return shaping.keep_columns(table(spark, d, "orders"), suffixes=["key"], names=["o_totalprice"])


@add("p8_filter_population", R + " SELECT race, num FROM runners WHERE (num % 2 = 1 OR track IN ('1-URGENT', '5-LOW')) AND finish IS NOT NULL AND status = 'O'")
def _(spark, d):
    r = runners(spark, d).withColumn("has_gps", (F.col("num") % 2).cast("int"))
    return shaping.filter_population(r, "has_gps", "track", ["1-URGENT", "5-LOW"], ["finish"], {"status": "O"}).select("race", "num")


@add("p9_has_all", P + " SELECT id, CASE WHEN gappy IS NOT NULL AND speed IS NOT NULL THEN 1 ELSE 0 END AS has_gps FROM points")
def _(spark, d):
    return shaping.has_all(points(spark, d), ["gappy", "speed"], "has_gps").select("id", "has_gps")


@add("p10_drop_missing_outcome", P + " SELECT id FROM points WHERE NOT (kind = 'click' AND (gappy IS NULL OR gappy = 0))")
def _(spark, d):
    return shaping.drop_missing_outcome(points(spark, d), "kind", "click", "gappy").select("id")


@add("p11_time_split", "SELECT o_orderkey, CASE WHEN o_orderdate < DATE '1996-01-01' THEN 'train' WHEN o_orderdate < DATE '1998-01-01' THEN 'valid' ELSE 'holdout' END AS part FROM orders")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    parts = shaping.time_split(o, "day", "1996-01-01", "1998-01-01")
    return sets.union_by_name(*(p.select("o_orderkey", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "valid", "holdout"), strict=True)))


@add("p12_cardinality_report", " UNION ALL ".join(f"SELECT '{c}' AS column, count(DISTINCT {c}) AS distinct_values, CASE WHEN count(DISTINCT {c}) <= 60 THEN 'categorical' ELSE 'continuous' END AS kind FROM part" for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")))
def _(spark, d):
    return shaping.cardinality_report(table(spark, d, "part"), 60)


@add("p12_cardinality_kinds", " UNION ALL ".join(f"SELECT '{c}' AS column, CASE WHEN count(DISTINCT {c}) <= 50 THEN 'categorical' ELSE 'continuous' END AS kind FROM lineitem" for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate", "l_extendedprice")))
def _(spark, d):
    cols = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate", "l_extendedprice"]
    return shaping.cardinality_kinds(table(spark, d, "lineitem"), 50, cols).select("column", "kind")


@add("p13_condition_bucket", R + """ SELECT race, num, CASE WHEN surface = 'P' AND model = 'A' THEN 'MUDDY' WHEN surface = 'P' THEN 'DIRT' WHEN surface = 'O' THEN 'TURF' WHEN surface = 'F' THEN 'ALL_WEATHER' END
  || CASE WHEN 1000 + num * 100 <= 1409 THEN '_SPRNT' ELSE '_RTE' END AS bucket FROM runners""")  # fmt: skip
def _(spark, d):
    surface = F.translate("surface", "POF", "DTA")
    condition = F.when(F.col("model") == "A", "MY").otherwise("FT")
    metres = (1000 + F.col("num") * 100).cast("double")
    return runners(spark, d).select("race", "num", fn.condition_bucket(surface, condition, metres, F.lit("Claiming")).alias("bucket"))


@add("p14_time_folds", """WITH g AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1),
  b AS (SELECT o_custkey, ntile(4) OVER (ORDER BY first_day, o_custkey) - 1 AS b FROM g)
  SELECT fold, CASE WHEN b < fold THEN 'train' ELSE 'valid' END AS part, count(*) AS n FROM orders JOIN b USING (o_custkey), (VALUES (1), (2), (3)) f(fold) WHERE b <= fold GROUP BY ALL""")  # fmt: skip
def _(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return shaping.time_folds(o, "o_custkey", "day", 3).groupBy("fold", "part").agg(F.count(F.lit(1)).alias("n"))


@add("p15_trim_after_first", P + ", f AS (SELECT runner, min(id) AS stop FROM points WHERE kind = 'error' GROUP BY 1) SELECT id FROM points LEFT JOIN f USING (runner) WHERE stop IS NULL OR id <= stop")
def _(spark, d):
    return shaping.trim_after_first(points(spark, d), ["runner"], "id", F.col("kind") == "error").select("id")


@add("u1_union_by_name", "SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal, NULL AS seg FROM supplier UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer")
def _(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    return sets.union_by_name(a, b)


@add("u2_dedupe", R + " SELECT race, num, horse, jockey, price FROM runners")
def _(spark, d):
    return runners(spark, d).select("race", "num", "horse", "jockey", "price")


@add("u3_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, d):
    return sets.distinct_of(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@add("u4_keyed_difference", "SELECT c_custkey, 'without' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'with' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _(spark, d):
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return sets.keyed_difference(c, o, ["c_custkey"]).withColumn("side", F.lit("without")).unionByName(sets.keyed_intersection(c, o, ["c_custkey"]).withColumn("side", F.lit("with")))


@add("l1_global_sort", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(spark, d):
    return sets.sorted_by(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), [F.desc("o_totalprice"), "o_orderkey"])


@add("l2_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, d):
    return sets.top_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25)


@add("l3_argmax_by", R + " SELECT race, price, horse, num FROM runners WHERE finish = 1")
def _(spark, d):
    return sets.argmax_by(runners(spark, d), ["race"], "price", ["num"], ["horse", "num"])


@add("l4_natural_key", """WITH k AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE c_nationkey || chr(CAST(65 + c_custkey % 4 AS INTEGER)) END AS cloth FROM customer)
  SELECT c_custkey, cloth, row_number() OVER (PARTITION BY c_custkey // 20 ORDER BY CAST(regexp_extract(cloth, '^\\d*') AS INTEGER), regexp_replace(cloth, '^\\d*', ''), c_custkey) AS pos FROM k""")  # fmt: skip
def _(spark, d):
    from pyspark.sql import Window

    cloth = F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey").cast("string")).otherwise(F.concat(F.col("c_nationkey").cast("string"), F.char(65 + F.col("c_custkey") % 4)))
    k = table(spark, d, "customer").select("c_custkey", cloth.alias("cloth"))
    w = Window.partitionBy(F.floor(F.col("c_custkey") / 20)).orderBy(sets.natural_key(F.col("cloth")), "c_custkey")
    return k.withColumn("pos", F.row_number().over(w).cast("long"))


@add("l5_last_n", P + " SELECT runner, id FROM (SELECT *, row_number() OVER (PARTITION BY runner ORDER BY ts DESC, id DESC) AS rn FROM points) WHERE rn <= 3")
def _(spark, d):
    return sets.last_n(points(spark, d), ["runner"], [F.desc("ts"), F.desc("id")], 3).select("runner", "id")


@add("f1_gate_number", """SELECT event_id, CASE event_id % 8 WHEN 0 THEN CAST(event_id % 9 AS DOUBLE) WHEN 1 THEN event_id % 9 + 0.5 WHEN 2 THEN round(event_id % 9 + (event_id % 600) / CAST(660 AS DOUBLE), 6)
  WHEN 3 THEN 9999.0 WHEN 4 THEN round(event_id % 9 + 0.5 + (event_id % 600 + 0.5) / CAST(660 AS DOUBLE), 6) END AS gate FROM events""")
def _(spark, d):
    i = F.col("event_id")
    nine, feet = (i % 9).cast("string"), (i % 600).cast("string")
    forms = [F.concat(nine, F.lit("f")), F.concat(nine, F.lit(".5f")), F.concat(nine, F.lit("F"), feet, F.lit("ft ")), F.lit("Finish"), F.concat(nine, F.lit(".5f"), feet, F.lit(".5ft")), F.lit("prefinish"), F.concat(nine, F.lit("fxyz")), F.lit("start")]
    return table(spark, d, "events").select("event_id", F.round(fn.gate_number(F.get(F.array(*forms), i % 8)), 6).alias("gate"))


@add("f2_odds_to_prob", "SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE round(1 / ((event_id % 30) / CAST(1 + event_id % 4 AS DOUBLE) + 1), 6) END AS prob FROM events")
def _(spark, d):
    i = F.col("event_id")
    odds = F.when(i % 11 == 0, "scratched").otherwise(F.concat((i % 30).cast("string"), F.lit("/"), (1 + i % 4).cast("string")))
    return table(spark, d, "events").select("event_id", F.round(fn.odds_to_prob(odds), 6).alias("prob"))


@add("f3_parse_dates", """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 = 3 THEN DATE '1970-01-01' ELSE o_orderdate END AS DATE) AS day,
  CASE o_orderkey % 3 WHEN 0 THEN '09:05:00' WHEN 1 THEN '14:30:15' ELSE '13:05:00' END AS at, round((o_orderkey % 3) * 60 + (o_orderkey % 60) + CAST(0.25 AS DOUBLE), 6) AS secs FROM orders""")  # fmt: skip
def _(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    said = F.when(k % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(k % 4 == 1, F.date_format(day, "yyyyMMdd")).when(k % 4 == 2, F.date_format(day, "MM/dd/yyyy")).otherwise("soon")
    time = F.when(k % 3 == 0, "09:05").when(k % 3 == 1, "14:30:15").otherwise("1:05PM")
    secs = F.format_string("%d.25", k % 60)
    return table(spark, d, "orders").select(
        "o_orderkey", fn.parse_date(said, default="1970-01-01").alias("day"), fn.parse_time(time).alias("at"),
        F.round(fn.parse_duration(F.when(k % 3 == 0, secs).otherwise(F.concat((k % 3).cast("string"), F.lit(":"), secs))), 6).alias("secs"),
    )


@add("f4_race_identifier", R + """ SELECT race, num, to_base64(encode(rpad(upper(left(model || surface, 3)), 3, ' ') || strftime(race_date, '%Y%m%d') || lpad(CAST(num AS VARCHAR), 2, '0'))) AS ident, model || surface AS course, race_date AS day, num AS number FROM runners""")
def _(spark, d):
    ident = fn.race_identifier(F.concat("model", "surface"), F.col("race_date"), F.col("num"))
    back = runners(spark, d).withColumn("ident", ident).withColumn("b", fn.decode_race_identifier(F.col("ident")))
    return back.select("race", "num", "ident", F.col("b.course").alias("course"), F.col("b.date").alias("day"), F.col("b.number").alias("number"))


@add("f5_safe_num", "SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN 0.0 WHEN value >= 50 THEN 0.0 ELSE value END AS num FROM events")
def _(spark, d):
    said = F.when(F.col("event_id") % 7 == 0, "NA").when(F.col("event_id") % 7 == 1, " ").otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", fn.safe_num(said, max_abs=50.0, default=0.0).alias("num"))


@add("f6_parse_winners", R + " SELECT race, string_agg(CAST(num AS VARCHAR), '|' ORDER BY finish) AS legs, count(*) AS n_legs FROM runners WHERE finish <= 2 GROUP BY race")
def _(spark, d):
    text = runners(spark, d).filter("finish <= 2").groupBy("race").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("finish", "num"))), lambda x: x["num"].cast("string")), "-").alias("w"))
    legs = fn.parse_winners(F.col("w"))
    return text.select("race", F.array_join(F.flatten(legs), "|").alias("legs"), F.size(legs).cast("long").alias("n_legs"))


@add("f7_clean_text", r"SELECT p_partkey, trim(left(regexp_replace(p_name || '! (' || p_brand || ')', '[^\w\s]', '', 'g'), 16)) AS name FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.clean_text(F.concat("p_name", F.lit("! ("), "p_brand", F.lit(")")), 16).alias("name"))


@add("f8_cloth_number", "SELECT event_id, regexp_replace(replace(right(lpad(CAST(event_id % 100 AS VARCHAR), 2, CASE WHEN event_id % 2 = 0 THEN ' ' ELSE '0' END), 2), ' ', ''), '^0', '') AS cloth FROM events")
def _(spark, d):
    i = F.col("event_id")
    two = (i % 100).cast("string")
    feed = F.concat(F.lit("AB2024"), F.when(i % 2 == 0, F.lpad(two, 2, " ")).otherwise(F.lpad(two, 2, "0")))
    return table(spark, d, "events").select("event_id", fn.cloth_number(feed).alias("cloth"))


@add("f9_points_of_call", R + " SELECT race, num, 2 AS n_calls, finish AS last_position, num * 0.5::DOUBLE AS last_lengths FROM runners")
def _(spark, d):
    xml = F.format_string('<r><poc name="1/2"><position>%d</position><lengths>1.0</lengths></poc><poc name="FIN"><position>%d</position><lengths>%s</lengths></poc></r>', F.col("num"), F.col("finish"), (F.col("num") * 0.5).cast("string"))
    calls = runners(spark, d).select("race", "num", fn.points_of_call(xml).alias("c"))
    return calls.select("race", "num", F.size("c").alias("n_calls"), F.element_at("c", -1)["position"].cast("long").alias("last_position"), F.element_at("c", -1)["lengths"].alias("last_lengths"))


@add("f10_age_years", "SELECT o_orderkey, round(date_diff('day', DATE '1990-05-04', CAST(o_orderdate AS DATE)) / 365.25, 6) AS age, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS days FROM orders")
def _(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.round(fn.age_years(day, F.lit("1990-05-04").cast("date")), 6).alias("age"), F.unix_date(day).cast("long").alias("days"))


@add("f11_epoch_days", "SELECT event_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS days FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", fn.epoch_days(F.col("ts")).cast("long").alias("days"))


@add("f12_add_seconds", "SELECT event_id, epoch_us(ts) + CAST(round(value * 1e6) AS BIGINT) AS us FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", micros(fn.add_seconds(F.col("ts"), F.col("value"))).alias("us"))


@add("f13_same_set", R + """, a AS (SELECT race, list(num ORDER BY finish) AS f, list(num ORDER BY score DESC, num) AS p FROM runners GROUP BY race)
  SELECT race, list_sort(f[1:4]) = list_sort(p[1:4]) AS any_order, f[1:4] = p[1:4] AS exact_order FROM a""")  # fmt: skip
def _(spark, d):
    r = runners(spark, d)
    listed = lambda *k: F.slice(F.transform(F.array_sort(F.collect_list(F.struct(*k, "num"))), lambda x: x["num"]), 1, 4)
    a = r.groupBy("race").agg(listed("finish").alias("f"), listed((-F.col("score")).alias("s")).alias("p"))
    return a.select("race", fn.same_set(F.col("f"), F.col("p")).alias("any_order"), (F.col("f") == F.col("p")).alias("exact_order"))


@add("f14_pad_array", R + ", a AS (SELECT race, list(num ORDER BY num) AS a FROM runners GROUP BY race) SELECT race, array_to_string(list_resize(a, 5, -1), ',') AS padded, array_to_string(list_resize([-1, -1, -1, -1, -1], greatest(5 - len(a), 0)) || a[1:5], ',') AS front FROM a")
def _(spark, d):
    a = runners(spark, d).groupBy("race").agg(F.array_sort(F.collect_list("num")).alias("a"))
    join = lambda side: F.array_join(F.transform(fn.pad_array(F.col("a"), 5, F.lit(-1), side), lambda x: x.cast("string")), ",")
    return a.select("race", join("right").alias("padded"), join("left").alias("front"))


@add("f16_safe_name", "SELECT c_custkey, c_acctbal AS m_2024_model_v1_2 FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias(fn.safe_name("models/2024-model v1.2.bin")))


@add("f17_expand_array", "SELECT vec_id, embedding[1] AS dim1, embedding[2] AS dim2, embedding[3] AS dim3, len(embedding) AS n FROM embeddings")
def _(spark, d):
    e = table(spark, d, "embeddings")
    nested = e.withColumn("embedding", fn.flatten_array(F.array(F.slice("embedding", 1, 2), F.slice("embedding", 3, 1 << 20))))
    return fn.expand_array(nested, "embedding", 3, "dim").select("vec_id", "dim1", "dim2", "dim3", F.size("embedding").cast("long").alias("n"))


@add("f18_ranking_lists", R + ", a AS (SELECT race, list(num ORDER BY finish) AS a FROM runners GROUP BY race HAVING count(*) > 1) SELECT race, array_to_string(list_resize(a, 8, 0), ',') AS ranking FROM a")
def _(spark, d):
    a = runners(spark, d).groupBy("race").agg(F.transform(F.array_sort(F.collect_list(F.struct("finish", "num"))), lambda x: x["num"]).alias("a")).filter(F.size("a") > 1)
    return a.select("race", F.array_join(F.transform(fn.pad_array(F.col("a"), 8, F.lit(0)), lambda x: x.cast("string")), ",").alias("ranking"))


