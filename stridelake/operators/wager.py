"""Wager back-test on arrays and joins: B1-B14."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.operators import hot_keys
from stridelake.sources.shared import folder, stored


def race_frame(df: DataFrame, race: Sequence[str], item: str, score: str, least: int = 5, most: int = 14, carry: Mapping[str, str] | None = None) -> DataFrame:
    """One row a race: its runners by score, the gaps of neighbours, and the field; small and large fields go.

    A field is bounded by the runners of a race, so it fits one array.
    """
    extra = {name: F.col(c).alias(name) for name, c in (carry or {}).items()}
    order = F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("k"), F.col(item).cast("string").alias("item"), F.col(score).cast("double").alias("score"), *extra.values())))
    out = df.filter(F.col(score).isNotNull()).groupBy(*race).agg(order.alias("runners")).withColumn("field", F.size("runners"))
    gap = lambda i: F.greatest(F.coalesce(F.get("runners", F.lit(i - 1))["score"] - F.get("runners", F.lit(i))["score"], F.lit(0.0)), F.lit(0.0))
    out = out.withColumns({f"gap{i}{i + 1}": gap(i) for i in range(1, 5)})
    return out.filter(F.col("field").between(least, most))


@dataclass(frozen=True)
class Rule:
    """A named rule: bounds on gaps (a missing one is open), a ticket style and a share of the bankroll."""

    name: str
    bounds: tuple[tuple[str, float | None, float | None], ...]
    style: str
    pct: float


#: Fixed values of the exacta rules.
EXACTA_RULES = (
    Rule("Huge gaps straight", (("gap12", 0.30, None), ("gap23", 0.15, None)), "STRAIGHT", 0.05),
    Rule("Big gap key12", (("gap12", 0.40, None), ("gap23", None, 0.15)), "KEY12", 0.01),
    Rule("Box 1-2", (("gap12", None, 0.15), ("gap23", 0.25, None)), "BOX12", 0.01),
)
#: Fixed values of the trifecta rules.
TRIFECTA_RULES = (
    Rule("Straight 1-2-3", (("gap12", 0.25, None), ("gap23", 0.15, None), ("gap34", 0.10, None)), "STRAIGHT123", 0.05),
    Rule("Key 1 over 2,3", (("gap12", 0.18, None), ("gap23", None, 0.12), ("gap34", 0.08, None)), "KEY1_23", 0.04),
    Rule("Key 1,2 over 3", (("gap12", None, 0.12), ("gap23", 0.12, None), ("gap34", 0.05, None)), "KEY12_3", 0.03),
    Rule("Box 1-2-3", (("gap12", None, 0.12), ("gap23", None, 0.12), ("gap34", None, 0.12)), "BOX123", 0.02),
)


def match_rule(df: DataFrame, rules: Sequence[Rule], monotone: Sequence[str] = ()) -> DataFrame:
    """The first rule that fits each race, as columns rule, style, pct; races without one go.

    ``monotone`` names columns that must rise strictly before any rule is tried (B3).
    """
    found = F.lit(None).cast("struct<rule:string,style:string,pct:double>")
    for r in reversed(rules):
        fits = F.lit(True)
        for col, lo, hi in r.bounds:
            if lo is not None:
                fits &= F.col(col) >= lo
            if hi is not None:
                fits &= F.col(col) <= hi
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.style).alias("style"), F.lit(r.pct).alias("pct"))).otherwise(found)
    for a, b in zip(monotone, monotone[1:], strict=False):
        df = df.filter(F.col(a) < F.col(b))
    return df.withColumn("__m", found).filter(F.col("__m").isNotNull()).select(*df.columns, "__m.*")


#: Runners' places (from 0) on the tickets of each style.
STYLES: dict[str, list[tuple[int, ...]]] = {
    "STRAIGHT": [(0, 1)],
    "KEY12": [(0, 1), (0, 2)],
    "BOX12": [(0, 1), (1, 0)],
    "STRAIGHT123": [(0, 1, 2)],
    "KEY1_23": [(0, 1, 2), (0, 2, 1)],
    "KEY12_3": [(0, 1, 2), (1, 0, 2)],
    "BOX123": list(permutations(range(3))),
}


def box_style(n: int, size: int) -> list[tuple[int, ...]]:
    """All orders of ``size`` of the first n runners."""
    return list(permutations(range(n), size))


def tickets(df: DataFrame, style: str = "style", styles: Mapping[str, Sequence[tuple[int, ...]]] = STYLES, runners: str = "runners") -> DataFrame:
    """One row a ticket, an array of program numbers; fields too short for a style give none."""
    chosen = F.lit(None).cast("array<array<int>>")
    for name, places in styles.items():
        chosen = F.when(F.col(style) == name, F.array(*(F.array(*map(F.lit, p)) for p in places))).otherwise(chosen)
    names = F.transform(runners, lambda r: r["item"])
    made = df.withColumn("__p", F.explode(chosen)).withColumn("ticket", F.transform("__p", lambda i: F.get(names, i)))
    return made.filter(~F.exists("ticket", lambda t: t.isNull())).drop("__p")


def close_box(df: DataFrame, margin: float = 0.05, cap: int = 4, least: int = 2, runners: str = "runners") -> DataFrame:
    """Runners within a margin of the leader, so many at most; races with fewer than ``least`` go."""
    lead = F.get(runners, F.lit(0))["score"]
    close = F.slice(F.transform(F.filter(runners, lambda r: r["score"] >= lead - margin), lambda r: r["item"]), 1, cap)
    return df.withColumn("box", close).filter(F.size("box") >= least)


def multi_leg(wagers: DataFrame, races: DataFrame, card: Sequence[str], number: str, n_legs: int, top: int = 2, least: int = 4, most: int = 20, runners: str = "runners") -> DataFrame:
    """Tickets of a multi-race wager that ends at a race number: the product of each leg's first runners.

    A wager with a missing leg, or one whose field is outside the bounds, gives none.
    """
    legs = races.filter(F.size(runners).between(least, most)).select(*card, F.col(number).alias("__n"), F.slice(F.transform(runners, lambda r: r["item"]), 1, top).alias("__c"))
    out = wagers
    for k in range(n_legs):
        side = legs.select(*card, (F.col("__n") + (n_legs - 1 - k)).alias(number), F.col("__c").alias(f"__c{k}"))
        out = out.join(side, [*card, number])
    combos = F.transform(F.col("__c0"), lambda x: F.array(x))
    for k in range(1, n_legs):
        combos = _with_leg(combos, F.col(f"__c{k}"))
    return out.withColumn("ticket", F.explode(combos)).drop(*(f"__c{k}" for k in range(n_legs)))


def _with_leg(combos: Column, choices: Column) -> Column:
    """Every combination so far with every choice of one more leg."""
    return F.flatten(F.transform(combos, lambda done: F.transform(choices, lambda x: F.concat(done, F.array(x)))))


def settle(bets: DataFrame, results: DataFrame, on: Sequence[str], stake: str = "stake", winners: str = "winners", payoff: str = "posted_payoff", base: str = "posted_base") -> DataFrame:
    """Hit and payoff of tickets: each place must be among that leg's (tied) winners; paid by stake over base."""
    joined = bets.join(results, list(on), "left")
    win = (F.size("ticket") == F.size(winners)) & F.forall(F.zip_with("ticket", winners, lambda t, w: F.coalesce(F.array_contains(w, t), F.lit(False))), lambda x: x)
    hit = F.coalesce(win, F.lit(False))
    return joined.withColumn("hit", hit).withColumn("payoff", F.when(F.col("hit"), F.coalesce(F.try_divide(F.col(payoff) * F.col(stake), F.col(base)), F.lit(0.0))).otherwise(0.0))


def bet_metrics(df: DataFrame, race: Sequence[str], stake: str = "stake") -> DataFrame:
    """One row a bet: combinations, cost, payoff, net, hit and return."""
    out = df.groupBy(*race).agg(F.count(F.lit(1)).alias("combos"), F.sum(stake).alias("cost"), F.sum("payoff").alias("payoff"), F.max(F.col("hit").cast("int")).alias("hit"))
    return out.withColumn("net", F.col("payoff") - F.col("cost")).withColumn("roi", F.try_divide(F.col("net"), F.col("cost")))


def stake(df: DataFrame, bankroll: float, unit: float, combos: str = "combos", pct: str = "pct") -> DataFrame:
    """Stake of each combination: a share of the bankroll raised by the gaps, at least a unit, snapped half to even."""
    factor = lambda g: F.least(F.col(g) / 0.10, F.lit(1.0)) * 0.5
    whole = F.greatest(F.lit(unit), F.lit(bankroll) * F.col(pct) * (1 + factor("gap12") + factor("gap23")))
    return df.withColumn("stake", F.round(F.lit(unit) * F.bround(whole / F.col(combos) / unit), 2))


def bankroll_path(df: DataFrame, strategy: str, order: Sequence[str], start: float, cost: str = "cost", payoff: str = "payoff") -> DataFrame:
    """Bankroll after all bets when a bet is only placed if it can be paid: a fold in the order of the bets.

    The fold is sequential by nature, so a strategy's bets go through one task, as
    a sorted stream of which a few numbers are kept; strategies are dealt out. A
    null cost or payoff counts as 0.
    """
    kind = df.select(strategy).schema[0].dataType
    money = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(n) for c, n in ((cost, "cost"), (payoff, "payoff"))]
    rows = df.select(F.col(strategy).alias("strategy"), *(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), *money)
    dealt = rows.repartition("strategy").sortWithinPartitions("strategy", *(f"o{k}" for k in range(len(order))), "cost", "payoff").select("strategy", "cost", "payoff")
    folded = dealt.mapInArrow(_fold(float(start)), f"strategy {kind.simpleString()}, bets int, placed int, final_bankroll double, lowest_bankroll double")
    return folded.withColumnRenamed("strategy", strategy)


def _fold(start: float):
    """A task over bets sorted by strategy: one row for each strategy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["strategy", "bets", "placed", "final_bankroll", "lowest_bankroll"]
        kinds = [None, pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        now, state, open_group = None, (0, 0, start, start), False
        schema = None
        for batch in batches:
            schema = batch.schema.field("strategy").type
            done = []
            for key, cost, payoff in zip(*(batch.column(c).to_pylist() for c in ("strategy", "cost", "payoff")), strict=True):
                if not open_group or key != now:
                    if open_group:
                        done.append((now, *state))
                    now, state, open_group = key, (0, 0, start, start), True
                bets, placed, money, low = state
                if money >= cost:
                    money += payoff - cost
                    placed, low = placed + 1, min(low, money)
                state = (bets + 1, placed, money, low)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t or schema) for k, t in enumerate(kinds)], names=names)
        if open_group:
            yield pa.RecordBatch.from_arrays([pa.array([x], t or schema) for x, t in zip((now, *state), kinds, strict=True)], names=names)

    return run


#: Bets of a block on average, and rounds in which blocks are walked bet by bet before what is left goes through one stream.
BLOCK_BETS, BLOCK_ROUNDS = 100_000, 12
#: Amounts are counted in whole parts of this size, so that sums are the same in any order.
PARTS = 1_000_000
_STATE = "next int, bets long, placed long, money long, low long"


def bankroll_blocks(df: DataFrame, strategy: str, order: Sequence[str], start: float, block_bets: int = BLOCK_BETS, cost: str = "cost", payoff: str = "payoff") -> DataFrame:
    """What ``bankroll_path`` gives, with a strategy's bets dealt over tasks in blocks by the first ordering column.

    Of each block its tasks find what it adds, the bankroll that pays all of its
    bets, its cheapest bet and its lowest point. A bankroll that pays all takes the
    block as one addition, and one that does not pay the cheapest bet skips it. Only
    a block in between is walked bet by bet. The additions of all blocks of a
    strategy, a few numbers each, are one small task; a round ends at the first
    block to walk. Strategies with more than ``BLOCK_ROUNDS`` such blocks end in one
    stream from there on. Blocks and states are stored in the shared folder.
    Amounts are rounded to millionths, and sums of them are exact.
    """
    spark, kind = df.sparkSession, df.select(strategy).schema[0].dataType.simpleString()
    at, names = folder(spark, "bankroll"), [f"o{k}" for k in range(len(order))]
    whole = lambda c: F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * PARTS).cast("long")
    money = [whole(cost).alias("cost"), whole(payoff).alias("payoff")]
    rows = df.select(F.col(strategy).alias("strategy"), *(F.col(c).alias(n) for c, n in zip(order, names, strict=True)), *money)
    dealt = hot_keys.deal_out(rows, ["strategy"], "o0", block_bets).select("strategy", F.col("__slot").alias("slot"), *names, "cost", "payoff")
    bets = stored(dealt, f"{at}/bets")
    w = Window.partitionBy("strategy", "slot").orderBy(*names, "cost", "payoff").rowsBetween(Window.unboundedPreceding, -1)
    before, net = F.col("before"), F.col("payoff") - F.col("cost")
    summed = bets.withColumn("before", F.coalesce(F.sum(net).over(w), F.lit(0).cast("long"))).groupBy("strategy", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum(net).alias("net"), F.max(F.col("cost") - before).alias("need"), F.min("cost").alias("cheapest"), F.min(before + net).alias("lowest")
    )
    blocks = stored(summed, f"{at}/blocks").withColumnRenamed("strategy", "__s")
    same = F.col("strategy").eqNullSafe(F.col("__s"))
    zero = [F.lit(0).alias("next"), F.lit(0).cast("long").alias("bets"), F.lit(0).cast("long").alias("placed"), *(F.lit(round(start * PARTS)).cast("long").alias(c) for c in ("money", "low"))]
    state, done = blocks.select(F.col("__s").alias("strategy")).distinct().select("strategy", *zero), None
    bets = bets.withColumnRenamed("strategy", "__s")
    for turn in range(BLOCK_ROUNDS + 1):
        ahead = state.join(blocks, same & (F.col("slot") >= F.col("next")), "left").drop("__s")
        added = ahead.repartition("strategy").sortWithinPartitions("strategy", "slot").mapInArrow(_add_blocks, f"strategy {kind}, {_STATE}, open boolean")
        added = stored(added, f"{at}/added-{turn}")
        ended = added.filter("not open")
        done = ended if done is None else done.unionByName(ended)
        still = added.filter("open").drop("open")
        if still.isEmpty():
            break
        last = turn == BLOCK_ROUNDS
        to_walk = still.join(bets, same & ((F.col("slot") >= F.col("next")) if last else (F.col("slot") == F.col("next")))).drop("__s")
        walked = to_walk.repartition("strategy").sortWithinPartitions("strategy", "slot", *names, "cost", "payoff").select("strategy", "next", "bets", "placed", "money", "low", "cost", "payoff")
        state = stored(walked.mapInArrow(_walk, f"strategy {kind}, {_STATE}"), f"{at}/walked-{turn}")
        if last:
            done = done.unionByName(state.withColumn("open", F.lit(False)))
    return done.select(F.col("strategy").alias(strategy), F.col("bets").cast("int").alias("bets"), F.col("placed").cast("int").alias("placed"), (F.col("money") / PARTS).alias("final_bankroll"), (F.col("low") / PARTS).alias("lowest_bankroll"))


def _folded(batches: Iterator[pa.RecordBatch], names: Sequence[str], step, tail: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    """Fold each strategy's rows: ``step(state, row)`` gives the next state; the first row holds the first one."""
    columns = ["strategy", "next", "bets", "placed", "money", "low", *tail]
    types = [pa.int32(), *[pa.int64()] * 4, *([pa.bool_()] * len(tail))]
    now, state, kind, begun = None, None, None, False
    for batch in batches:
        kind = batch.schema.field("strategy").type
        for key, *values in zip(*(batch.column(c).to_pylist() for c in ("strategy", *names)), strict=True):
            if not begun or key != now:
                if begun:
                    yield pa.RecordBatch.from_arrays([pa.array([now], kind), *(pa.array([x], t) for x, t in zip(state, types, strict=True))], names=columns)
                now, state, begun = key, (*values[:5], *([False] * len(tail))), True
            state = step(state, values[5:])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([now], kind), *(pa.array([x], t) for x, t in zip(state, types, strict=True))], names=columns)


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that are paid or skipped as a whole, up to the first that is neither, at which a strategy is open."""

    def step(state: tuple, block: Sequence) -> tuple:
        following, bets, placed, money, low, is_open = state
        slot, n, net, need, cheapest, lowest = block
        if is_open or slot is None:
            return state
        if money >= need:
            return slot + 1, bets + n, placed + n, money + net, min(low, money + lowest), False
        if money < cheapest:
            return slot + 1, bets + n, placed, money, low, False
        return slot, bets, placed, money, low, True

    yield from _folded(batches, ["next", "bets", "placed", "money", "low", "slot", "n", "net", "need", "cheapest", "lowest"], step, ["open"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bets of a block, one by one."""

    def step(state: tuple, bet: Sequence) -> tuple:
        following, bets, placed, money, low = state
        cost, payoff = bet
        if money >= cost:
            money += payoff - cost
            placed, low = placed + 1, min(low, money)
        return following, bets + 1, placed, money, low

    for out in _folded(batches, ["next", "bets", "placed", "money", "low", "cost", "payoff"], step):
        yield out.set_column(1, "next", pa.array([out.column("next")[0].as_py() + 1], pa.int32()))


def grid_search(df: DataFrame, grid: Mapping[str, Sequence[float]], cost: str = "cost", payoff: str = "payoff") -> DataFrame:
    """Return of the rows at or over every combination of two columns' thresholds, in one job.

    Rows are first summed by the steps of the grid that they reach; only those few
    sums meet the combinations.
    """
    (a, first), (b, second) = ((c, sorted(v)) for c, v in grid.items())
    step = lambda c, levels: sum((F.when(F.col(c) >= g, 1).otherwise(0) for g in levels), F.lit(0))
    sums = df.groupBy(step(a, first).alias("__a"), step(b, second).alias("__b")).agg(F.count(F.lit(1)).alias("n"), F.sum(cost).alias("c"), F.sum(payoff).alias("p"))
    cells = F.explode(F.array(*(F.struct(F.lit(float(x)).alias(f"min_{a}"), F.lit(float(y)).alias(f"min_{b}"), F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j")) for i, x in enumerate(first) for j, y in enumerate(second))))
    spread = sums.select("*", cells.alias("w"))
    inside = (F.col("__a") >= F.col("w.i")) & (F.col("__b") >= F.col("w.j"))
    take = lambda c: F.sum(F.when(inside, F.col(c)).otherwise(0))
    out = spread.groupBy(F.col(f"w.min_{a}").alias(f"min_{a}"), F.col(f"w.min_{b}").alias(f"min_{b}")).agg(take("n").alias("bets"), take("c").alias("cost"), take("p").alias("payoff"))
    return out.withColumn("roi", F.try_divide(F.col("payoff") - F.col("cost"), F.col("cost")))


def advice(df: DataFrame, track: Sequence[str], number: str, gap12: str = "gap12", gap23: str = "gap23", t12: float = 0.10, t23: float = 0.05) -> DataFrame:
    """Ticket advice from the gaps, and the longest multi-race bet of confident consecutive races that begins here."""
    big = F.col(gap12) > t12
    df = df.withColumns({
        "advice": F.when(big & (F.col(gap23) > t23), "key 1 over 2").when(big, "key 1 over 2,3").otherwise("box 1,2,3"),
        "n_tickets": F.when(big & (F.col(gap23) > t23), 1).when(big, 2).otherwise(6),
        "confident": big.cast("int"),
    })
    w = Window.partitionBy(*track).orderBy(number)
    nxt = lambda k: F.coalesce(F.lead("confident", k).over(w), F.lit(0)) == 1
    two, three, four = nxt(1), nxt(1) & nxt(2), nxt(1) & nxt(2) & nxt(3)
    chain = F.when(F.col("confident") == 0, "none").when(four, "pick 4").when(three, "pick 3").when(two, "daily double").otherwise("none")
    return df.withColumn("multi_race", chain)


def upcoming(df: DataFrame, date: str, today: str, cols: Sequence[str]) -> DataFrame:
    """Distinct tracks and dates from a day on."""
    return df.filter(F.col(date) >= F.lit(today).cast("date")).select(*cols).distinct()


def best_arm(rewards: DataFrame, context: Sequence[str], arm: str = "arm", reward: str = "reward") -> DataFrame:
    """The arm with the highest mean reward in each context; ties go to the first by name."""
    means = rewards.groupBy(*context, arm).agg(F.avg(reward).alias("mean_reward"), F.count(F.lit(1)).alias("n"))
    pick = F.min_by(F.struct(arm, "mean_reward", "n"), F.struct((-F.col("mean_reward")).alias("m"), F.col(arm).alias("a")))
    return means.groupBy(*context).agg(pick.alias("__b")).select(*context, F.col(f"__b.{arm}").alias("chosen_arm"), F.col("__b.mean_reward").alias("mean_reward"), F.col("__b.n").alias("n"))
