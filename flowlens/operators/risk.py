"""Counterparty concentration and loss risk for every company at once.

Input is the shared ``edges_month`` pre-aggregate (payer, receiver, month,
channel -> value, count) over the whole ledger.  Company-level totals are
separate aggregations joined back; per-company top-k uses ``row_number``
filters (partial ``WindowGroupLimit`` before the shuffle), so hub companies
never put their whole neighbourhood into one task.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import banded
from ..session import bucketed, checkpoint_dir, stored


def pair_volumes(edges: DataFrame) -> DataFrame:
    """(src, dst) -> total value and payment count."""
    return edges.groupBy("src", "dst").agg(F.sum("valor").alias("v"), F.sum("n").alias("n"))


def partner_flows(pairs: DataFrame, parts: int | None = None) -> DataFrame:
    """(company, partner) -> value and payments received from / paid to the
    partner; with ``parts``, dealt by company into that many partitions."""
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    legs = pairs.select(F.explode(F.array(
        F.struct(F.col("dst").alias("company_id"), F.col("src").alias("partner_id"), F.col("v").alias("vin"),
                 zero.alias("vout"), F.col("n").cast("long").alias("nin"), none.alias("nout")),
        F.struct(F.col("src").alias("company_id"), F.col("dst").alias("partner_id"), zero.alias("vin"),
                 F.col("v").alias("vout"), none.alias("nin"), F.col("n").cast("long").alias("nout")),
    )).alias("l")).select("l.*")
    if parts:
        legs = legs.repartition(parts, "company_id")  # at most two rows a key: nothing to combine before
    return legs.groupBy("company_id", "partner_id").agg(*(F.sum(c).alias(c) for c in ("vin", "vout", "nin", "nout")))


def partner_flows_by_company(pairs: DataFrame) -> DataFrame:
    """``partner_flows`` as a table bucketed by company.  A company has at most
    as many rows as there are companies, whatever its payments."""
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(partner_flows(pairs, parts), "company_id", parts, prefix="partner_flows")


def _level(x) -> F.Column:
    return banded(x, C.RISK_LEVELS, C.RISK_LEVEL_LAST)


def concentration_metrics(pairs: DataFrame, companies: DataFrame, flows: DataFrame | None = None) -> DataFrame:
    """Per company and direction (in / out / both): HHI, top partner share,
    top-3 share, number of partners, total and level (top > .5 CRÍTICO, else
    top-3 > .8 ALTO, > .6 MÉDIO, else BAIXO).  No payments or a zero total ->
    zeros and BAIXO.  A partner is one with a payment, whatever its amount.
    HHI is Σv²/total²; one aggregate yields the three directions, and the three
    largest amounts come out of it as the running top of each."""
    pf = partner_flows(pairs) if flows is None else flows
    value = {"in": F.when(F.col("nin") > 0, F.col("vin")), "out": F.when(F.col("nout") > 0, F.col("vout")),
             "both": F.col("vin") + F.col("vout")}
    legs = pf.select("company_id", "partner_id", *(v.alias(f"v_{d}") for d, v in value.items()))
    sums = [f(F.col(f"v_{d}")).alias(f"{name}_{d}") for d in value for name, f in (
        ("total", F.sum), ("sq", lambda v: F.sum(v * v)), ("n", F.count))]
    tot = legs.groupBy("company_id").agg(*sums)
    long = legs.select("company_id", "partner_id", F.explode(F.array(
        *[F.when(F.col(f"v_{d}").isNotNull(), F.struct(F.lit(d).alias("direction"), F.col(f"v_{d}").alias("v"))) for d in value])).alias("d")
    ).filter(F.col("d").isNotNull()).select("company_id", "partner_id", "d.direction", "d.v")
    w = Window.partitionBy("company_id", "direction").orderBy(F.col("v").desc(), "partner_id")
    top3 = (long.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 3)  # 3 rows a company and direction
            .groupBy("company_id").agg(*(F.sum(F.when(F.col("direction") == d, F.col("v"))).alias(f"top3_{d}") for d in value),
                                       *(F.max(F.when(F.col("direction") == d, F.col("v"))).alias(f"top_{d}") for d in value)))
    m = tot.join(top3, "company_id").select("company_id", F.explode(F.array(*[F.struct(
        F.lit(d).alias("direction"), F.col(f"total_{d}").alias("total_volume"), F.col(f"sq_{d}").alias("_sq"), F.col(f"top_{d}").alias("_top"),
        F.col(f"top3_{d}").alias("_top3"), F.col(f"n_{d}").alias("_np")) for d in value])).alias("d")).select("company_id", "d.*").filter("_np > 0")
    ok = F.col("total_volume") != 0
    hhi = F.when(ok, F.col("_sq") / (F.col("total_volume") * F.col("total_volume"))).otherwise(0.0)
    top = F.when(ok, F.col("_top") / F.col("total_volume")).otherwise(0.0)
    t3 = F.when(ok, F.col("_top3") / F.col("total_volume")).otherwise(0.0)
    level = (F.when(~ok, F.lit("BAIXO")).when(top > 0.5, F.lit("CRÍTICO")).when(t3 > 0.8, F.lit("ALTO"))
             .when(t3 > 0.6, F.lit("MÉDIO")).otherwise(F.lit("BAIXO")))
    res = m.select("company_id", "direction", hhi.alias("hhi"), top.alias("top_partner_share"),
                   t3.alias("top_3_share"), F.when(ok, F.col("_np")).otherwise(0).cast("long").alias("num_partners"),
                   F.when(ok, F.col("total_volume")).otherwise(0.0).alias("total_volume"),
                   level.alias("concentration_risk"))
    ids = companies.select(F.col("ID").alias("company_id")).distinct()
    grid = ids.select("company_id", F.explode(F.array(*[F.lit(d) for d in ("in", "out", "both")])).alias("direction"))
    return grid.join(res, ["company_id", "direction"], "left").select(
        "company_id", "direction",
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("hhi", "top_partner_share", "top_3_share")],
        F.coalesce(F.col("num_partners"), F.lit(0)).cast("long").alias("num_partners"),
        F.coalesce(F.col("total_volume"), F.lit(0.0)).alias("total_volume"),
        F.coalesce(F.col("concentration_risk"), F.lit("BAIXO")).alias("concentration_risk"))


def counterparty_loss_impact(pairs: DataFrame, flows: DataFrame | None = None) -> DataFrame:
    """For every (company, partner) with a flow: share of the company's
    receipts and payments lost if the partner fails, the larger of the two,
    severity (.5/.3/.15) with recovery estimate, and the amounts at risk."""
    pf = partner_flows(pairs) if flows is None else flows
    tot = pf.groupBy("company_id").agg(F.sum("vin").alias("_tin"), F.sum("vout").alias("_tout"))
    j = pf.join(tot, "company_id")
    ir = F.when(F.col("_tin") > 0, F.col("vin") / F.col("_tin")).otherwise(F.lit(0.0))
    ip = F.when(F.col("_tout") > 0, F.col("vout") / F.col("_tout")).otherwise(F.lit(0.0))
    it = F.greatest(ir, ip)
    sev = banded(it, [(t, s) for t, s, _ in C.SEVERITY], C.SEVERITY_LAST[0])
    rec = banded(it, [(t, r) for t, _, r in C.SEVERITY], C.SEVERITY_LAST[1])
    return j.select("company_id", "partner_id", ir.alias("impact_receita_pct"), ip.alias("impact_pagamentos_pct"),
                    it.alias("impact_total_pct"), sev.alias("severity"), rec.alias("recovery_time_estimate"),
                    F.col("vin").alias("volume_at_risk_in"), F.col("vout").alias("volume_at_risk_out"))


def _top_k(impact: DataFrame, vol: str, k: int) -> DataFrame:
    w = Window.partitionBy("company_id").orderBy(F.col(vol).desc(), "partner_id")
    return (impact.filter(F.col(vol) > 0).withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") <= k))


def risk_scenarios(impact: DataFrame) -> DataFrame:
    """Up to three scenarios per company: loss of the top payer (receipts
    impact), loss of the top payee (payments impact) and the joint loss of
    up to three partners taken from the top-3 payers ∪ top-3 payees (only if
    that set has ≥2 members; the three with the largest impact, ties by id),
    impact = Σ max-impact, percentage capped at 100, level from the
    uncapped value.  ``description`` and ``mitigation_strategies`` are stable
    codes (constants.SCENARIO_TEXTS)."""
    cols = ["company_id", "partner_id", "impact_receita_pct", "impact_pagamentos_pct", "impact_total_pct"]
    imp = impact.select(*cols, "volume_at_risk_in", "volume_at_risk_out")
    payers = _top_k(imp, "volume_at_risk_in", 3)
    payees = _top_k(imp, "volume_at_risk_out", 3)
    s1 = payers.filter(F.col("_r") == 1).select(
        "company_id", F.lit("top_payer_loss").alias("scenario"), F.col("partner_id").alias("affected_companies"),
        (F.col("impact_receita_pct") * 100).alias("impact_percentage"),
        _level(F.col("impact_receita_pct")).alias("risk_level"))
    s2 = payees.filter(F.col("_r") == 1).select(
        "company_id", F.lit("top_payee_loss").alias("scenario"), F.col("partner_id").alias("affected_companies"),
        (F.col("impact_pagamentos_pct") * 100).alias("impact_percentage"),
        _level(F.col("impact_pagamentos_pct")).alias("risk_level"))
    u = payers.select(*cols).unionByName(payees.select(*cols)).distinct()
    wu = Window.partitionBy("company_id").orderBy(F.col("impact_total_pct").desc(), "partner_id")
    wc = Window.partitionBy("company_id")
    joint = (u.withColumn("_n", F.count(F.lit(1)).over(wc)).withColumn("_r", F.row_number().over(wu))
             .filter((F.col("_n") >= 2) & (F.col("_r") <= 3))
             .groupBy("company_id").agg(
                 F.sum("impact_total_pct").alias("_imp"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "partner_id"))),
                                          lambda s: s["partner_id"]), ",").alias("affected_companies")))
    s3 = joint.select("company_id", F.lit("top_partners_joint_loss").alias("scenario"), "affected_companies",
                      F.least(F.lit(100.0), F.col("_imp") * 100).alias("impact_percentage"),
                      _level(F.col("_imp")).alias("risk_level"))
    out = s1.unionByName(s2).unionByName(s3)
    description, mitigation = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    for name, (text, strategies) in C.SCENARIO_TEXTS.items():
        here = F.col("scenario") == name
        description = F.when(here, F.lit(text)).otherwise(description)
        mitigation = F.when(here, F.array(*[F.lit(x) for x in strategies])).otherwise(mitigation)
    return out.withColumns({"description": description, "mitigation_strategies": mitigation})


def node_profile(edges: DataFrame, flows: DataFrame | None = None) -> DataFrame:
    """Per company over the whole ledger: payments touching it, mean payment,
    distinct partners and the partner risk score.

    risk = <2 payments -> 0.8; else min(1, min(.5, cv/10) + .3*top partner
    share + .2/max(1, partners)), cv = sample std / (mean + 1e-6) of the
    monthly totals; with a single active month the std is undefined and the
    volatility term is .5."""
    node_legs = edges.select("year_month", "valor", "n", F.explode(F.array_distinct(F.array("src", "dst"))).alias("node"))
    monthly = node_legs.groupBy("node", "year_month").agg(F.sum("valor").alias("mv"), F.sum("n").alias("mn"))
    ms = monthly.groupBy("node").agg(
        F.sum("mn").alias("n_payments"), F.sum("mv").alias("_sum"),
        F.stddev_samp("mv").alias("_sd"), F.avg("mv").alias("_mean"))
    pf = partner_flows(pair_volumes(edges)) if flows is None else flows
    conc = pf.groupBy("company_id").agg(
        F.countDistinct("partner_id").alias("n_partners"),
        F.max(F.col("vin") + F.col("vout")).alias("_top"), F.sum(F.col("vin") + F.col("vout")).alias("_tot"))
    j = ms.join(conc, ms.node == conc.company_id).drop("company_id")
    top_share = F.when(F.col("_tot") != 0, F.col("_top") / F.col("_tot")).otherwise(F.lit(0.0))
    partners = F.when(F.col("_tot") != 0, F.col("n_partners")).otherwise(F.lit(0))
    cv = F.col("_sd") / (F.col("_mean") + F.lit(1e-6))
    vol_term = F.least(F.lit(0.5), cv / 10)  # NULL std -> least ignores NULL -> 0.5
    score = F.least(F.lit(1.0), vol_term + F.lit(0.3) * top_share
                    + F.lit(0.2) / F.greatest(F.lit(1), partners).cast("double"))
    risk = F.when(F.col("n_payments") < 2, F.lit(0.8)).otherwise(score)
    avg = F.col("_sum") / F.col("n_payments").cast("double")
    reason = (F.when((avg > 50000) & (F.col("n_partners") > 10), F.lit("high_volume_well_diversified"))
              .when(avg > 100000, F.lit("high_volume_potential"))
              .when(F.col("n_partners") > 15, F.lit("well_connected"))
              .otherwise(F.lit("diversification_opportunity")))
    return j.select(F.col("node").alias("partner_id"), F.col("n_payments").cast("long").alias("n_payments"),
                    avg.alias("avg_transaction_volume"), F.col("n_partners").cast("long").alias("diversification_level"),
                    risk.alias("risk_score"), reason.alias("recommendation_reason"))


def adjacency(edges: DataFrame | None = None, flows: DataFrame | None = None) -> DataFrame:
    """Distinct undirected partner pairs (both orientations); ``partner_flows`` has them already."""
    if flows is not None:
        return flows.select(F.col("company_id").alias("a"), F.col("partner_id").alias("b")).filter(F.col("a") != F.col("b"))
    p = edges.select("src", "dst").distinct()
    return (p.select(F.col("src").alias("a"), F.col("dst").alias("b"))
            .unionByName(p.select(F.col("dst").alias("a"), F.col("src").alias("b")))
            .filter(F.col("a") != F.col("b")).distinct())


def ranked_candidates(profile: DataFrame) -> DataFrame:
    """The profile with ``place``: 1.. in the order of (risk asc, mean payment
    desc, id asc).  Numbered by ranges of the order and their offsets, so no
    task sorts all companies; materialised, as range bounds are sampled."""
    order = [F.col("risk_score").asc(), F.col("avg_transaction_volume").desc(), F.col("partner_id").asc()]
    checkpoint_dir(profile.sparkSession)
    parts = profile.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    offsets = sizes.select("_part", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (parts.withColumn("_own", own).join(offsets, "_part")
            .withColumn("place", (F.col("_own") + F.col("_before")).cast("long")).drop("_part", "_own", "_before").checkpoint())


#: Candidates that one bit mask holds, and masks of the first and later rounds.
MASK_BITS, MASKS = 64, (1, 8, 64)
#: Partners of partners that one round may list, or this many for each pair of partners.
LISTED_ROWS, LISTED_PER_PAIR = 20_000_000, 2
#: Rows of a table of masks that go to every executor.
BROADCAST_ROWS = 500_000


def _block_of(place: F.Column, top_m: int, fanout: int, n: int) -> tuple[F.Column, int]:
    """Number of the block that holds a place, and the number of blocks of ``n`` places."""
    if fanout == 1:
        return F.ceil(place / F.lit(top_m)).cast("int"), math.ceil(n / top_m)
    ends = [top_m]
    while ends[-1] < n:
        ends.append(ends[-1] + top_m * fanout ** len(ends))
    return (sum((F.when(place > e, 1).otherwise(0) for e in ends[:-1]), F.lit(1))).cast("int"), len(ends)


def _by_masks(near: DataFrame, adj: DataFrame, cand: DataFrame, low: int, words: int) -> DataFrame:
    """c, new: places (ascending) of the candidates in low + 1 .. low + 64 * words
    that are partners of c's partners, but neither c nor partners of c.

    A company's mask has the bits of itself and of its partners.  What c's
    partners have together, less what c has, is new: its partners' own bits are
    among c's.  So a pair of partners is one row, whatever their partners."""
    part = cand.filter((F.col("place") > low) & (F.col("place") <= low + MASK_BITS * words)).select(
        F.col("partner_id").alias("b"), (F.col("place") - F.lit(low + 1)).alias("at"))
    bits = adj.join(F.broadcast(part), "b").select("a", "at").unionByName(part.select(F.col("b").alias("a"), "at"))  # 4096 rows at most
    word, bit = F.floor(F.col("at") / MASK_BITS), F.expr(f"shiftleft(1L, cast(at % {MASK_BITS} as int))")
    names = [f"m{i}" for i in range(words)]
    masks = stored(bits.groupBy("a").agg(*[F.bit_or(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(m) for i, m in enumerate(names)]), "masks")
    theirs = masks.withColumnRenamed("a", "p")
    if masks.count() * words <= BROADCAST_ROWS:
        theirs = F.broadcast(theirs)
    met = near.join(theirs, "p").groupBy("c").agg(*[F.bit_or(m).alias(f"t{i}") for i, m in enumerate(names)])
    found = met.join(masks.withColumnRenamed("a", "c"), "c", "left").select("c", F.array(*[
        F.col(f"t{i}").bitwiseAND(F.bitwise_not(F.coalesce(F.col(m), F.lit(0).cast("long")))) for i, m in enumerate(names)]).alias("w"))
    places = F.flatten(F.transform("w", lambda w, i: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(MASK_BITS - 1)), lambda j: F.getbit(w, j) == 1),
        lambda j: F.lit(low + 1).cast("long") + i * F.lit(MASK_BITS) + j)))
    return found.select("c", places.alias("new"))


def _by_lists(near: DataFrame, adj: DataFrame, cand: DataFrame, low: int, k: int) -> DataFrame:
    """c, new: the first ``k`` places behind ``low`` as in ``_by_masks``, by listing the partners' partners."""
    rest = cand.filter(F.col("place") > low).select(F.col("partner_id").alias("q"), "place")
    lists = adj.join(rest, adj.b == F.col("q")).select(F.col("a").alias("p"), "q", "place")
    met = near.join(lists, "p").filter(F.col("c") != F.col("q")).select("c", "q", "place").distinct()
    new = met.join(near.select("c", F.col("p").alias("q")), ["c", "q"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("c").orderBy("place"))
    return (new.withColumn("rank", rank).filter(F.col("rank") <= k)  # k rows a company
            .groupBy("c").agg(F.array_sort(F.collect_list("place")).alias("new")))


def diversification_targets(edges: DataFrame, k: int = 5, top_m: int = 64, fanout: int = 8,
                            profile: DataFrame | None = None, adj: DataFrame | None = None,
                            with_block: bool = False) -> DataFrame:
    """Best ``k`` new partners per company: partners of its partners, minus
    itself and its current partners, ranked by (risk asc, mean payment
    desc, id asc).

    A rank join by the threshold rule.  Candidates are read in that order, in
    rounds of 64, 512 and then 4096.  A round meets the partners of the
    companies that are still open, as bit masks; a company leaves as soon as it
    has ``k`` candidates, because all later ones rank after them, or as many as
    it has non-partners at all.  As soon as the partners' partners of the open
    companies are few rows, one round lists them and ends the search.

    The order is cut into blocks, the first of ``top_m``, each next one
    ``fanout`` times as long.  ``with_block`` adds the block in which a company
    had all it can have (the last block if it never had).  Rounds do not follow
    the blocks: short ones would need as many rounds as there are companies.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    if profile is None or adj is None:
        flows = partner_flows_by_company(pair_volumes(edges))
        profile = node_profile(edges, flows) if profile is None else profile
        adj = adjacency(flows=flows) if adj is None else adj
    cand = stored(ranked_candidates(profile), "candidates")
    degree = stored(adj.groupBy("a").agg(F.count(F.lit(1)).alias("_deg")), "degrees")
    n, pairs = cand.count(), degree.agg(F.coalesce(F.sum("_deg"), F.lit(0))).first()[0]
    # a company can find no more than the companies that are no partners of it
    open_ = stored(degree.select(F.col("a").alias("c"), F.least(F.lit(k), n - 1 - F.col("_deg")).alias("most"),
                                 F.array().cast("array<bigint>").alias("have")).filter("most > 0"), "open")
    out, low, turn = [], 0, 0
    while low < n and not open_.isEmpty():
        near = adj.select(F.col("a").alias("c"), F.col("b").alias("p")).join(open_.select("c"), "c", "left_semi")
        listed = near.groupBy("p").count().join(degree, F.col("p") == F.col("a")).agg(F.sum(F.col("count") * F.col("_deg"))).first()[0] or 0
        if listed <= max(LISTED_ROWS, LISTED_PER_PAIR * pairs):
            new, low = _by_lists(near, adj, cand, low, k), n
        else:
            words = MASKS[min(turn, len(MASKS) - 1)]
            new, low, turn = _by_masks(near, adj, cand, low, words), low + MASK_BITS * words, turn + 1
        have = F.slice(F.concat("have", F.coalesce("new", F.array().cast("array<bigint>"))), 1, k)
        held = stored(open_.join(new, "c", "left").select("c", "most", have.alias("have")), "held")
        full = F.size("have") >= F.col("most")
        out.append(held if low >= n else held.filter(full))
        open_ = held.filter(~full)
    rows = spark.createDataFrame([], "c string, most long, have array<bigint>")
    for r in out:
        rows = rows.unionByName(r)
    block, blocks = _block_of(F.element_at("have", F.col("most").cast("int")), top_m, fanout, n)
    rows = rows.select("c", F.when(F.size("have") >= F.col("most"), block).otherwise(F.lit(blocks)).alias("block"), F.posexplode("have").alias("_at", "place"))
    return rows.join(cand, "place").select(
        F.col("c").alias("company_id"), (F.col("_at") + 1).cast("long").alias("rank"), "partner_id", "avg_transaction_volume",
        "diversification_level", "risk_score", "recommendation_reason", *(["block"] if with_block else []))


def risk_report(pairs: DataFrame, scenarios: DataFrame, companies: DataFrame,
                months_window: int = 6, flows: DataFrame | None = None) -> DataFrame:
    """Consolidated score per company: 30·HHI_in + 30·HHI_out + 10·#(ALTO or
    CRÍTICO scenarios) + 30/max(1, partners); class from the uncapped
    score (70/50/30), reported score capped at 100.  ``period_months`` is
    echoed, not applied (as in the analysed system)."""
    pf = partner_flows(pairs) if flows is None else flows
    conc = concentration_metrics(pairs, companies, pf)
    hh = conc.groupBy("company_id").agg(
        F.max(F.when(F.col("direction") == "in", F.col("hhi"))).alias("hhi_in"),
        F.max(F.when(F.col("direction") == "out", F.col("hhi"))).alias("hhi_out"),
        F.max(F.when(F.col("direction") == "in", F.col("concentration_risk"))).alias("risk_in"),
        F.max(F.when(F.col("direction") == "out", F.col("concentration_risk"))).alias("risk_out"))
    sc = scenarios.groupBy("company_id").agg(
        F.count(F.when(F.col("risk_level").isin("ALTO", "CRÍTICO"), 1)).alias("n_high_scenarios"))
    np_ = pf.groupBy("company_id").agg(F.count(F.lit(1)).alias("partners"))
    j = hh.join(sc, "company_id", "left").join(np_, "company_id", "left")
    partners = F.coalesce(F.col("partners"), F.lit(0))
    nh = F.coalesce(F.col("n_high_scenarios"), F.lit(0))
    raw = (F.col("hhi_in") * 30 + F.col("hhi_out") * 30 + nh * 10
           + F.lit(30.0) / F.greatest(F.lit(1), partners).cast("double"))
    cls = banded(raw, C.OVERALL_RISK, C.RISK_LEVEL_LAST)
    return j.select("company_id", F.lit(months_window).alias("period_months"), "hhi_in", "hhi_out",
                    "risk_in", "risk_out", nh.cast("long").alias("n_high_scenarios"),
                    partners.cast("long").alias("current_partners_count"),
                    F.least(F.lit(100.0), raw).alias("overall_risk_score"), cls.alias("risk_classification"))
