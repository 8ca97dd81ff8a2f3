"""Station-name resolution (J3-J6, L2): override -> exact -> trigram fuzzy.

Fuzzy matching is a set-similarity join with prefix filtering: grams are
ordered globally by (frequency, gram); a pair with Jaccard >= t must share a
gram among the first ``n - ceil(t*n) + 1`` grams of each side. Only those
rare-gram prefixes are joined, so a gram shared by a large share of all names
(a hot key) is almost never a join key; the size filter
``min(na, nb) >= t * max(na, nb)`` and an exact verification follow. The
result is exact: no candidate cap, no sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.constants import NAME_PREFIX
from railyard.functions.names import strip_prefix
from railyard.functions.trigram import similarity_from_sets, trigrams
from railyard.session import write_table, write_table_observed

# Prefix rows of a gram on one side above which they are dealt out to several tasks.
HEAVY_ROWS = 10_000
# Threshold 0.4 as the integer ratio 2/5 (strict: similarity > 2/5).
T_NUM, T_DEN = 2, 5


def _prefixes(g: DataFrame, freq: DataFrame) -> DataFrame:
    """``key, n, at, gram``: the rarest ``n - ceil(t*n) + 1`` grams of each set with their place in the order."""
    ranked = g.select("key", "n", F.explode("grams").alias("gram")).join(freq, "gram")
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(T_NUM) / F.lit(T_DEN)) + 1
    per_set = ranked.groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("freq", "gram"))).alias("ordered"))
    return per_set.select("key", "n", F.posexplode(F.slice("ordered", F.lit(1), keep.cast("int"))).alias("at", "p")) \
        .select("key", "n", "at", F.col("p.gram").alias("gram"))


def dealt_by_gram(probes: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides ready to be joined, and the columns to join them on.

    The rows of a measured heavy gram are dealt into parts of about ``HEAVY_ROWS``
    on the side where they are many, and repeated for each of these parts on
    the other side, so that no task gets all of a gram that half of the names share.
    """
    count = lambda rows, name: rows.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / HEAVY_ROWS).cast("int").alias(name))
    heavy = count(probes, "p_parts").join(count(stations, "s_parts"), "gram").filter("p_parts > 1 OR s_parts > 1")
    heavy, n = write_table_observed(heavy, "fuzzy-heavy")
    if not n:
        return probes, stations, ["gram"]

    def dealt(rows: DataFrame, key: str, own: str, other: str) -> DataFrame:
        parts = lambda side: F.coalesce(F.col(f"{side}_parts"), F.lit(1))
        return rows.join(heavy, "gram", "left").withColumn(f"{own}_part", F.pmod(F.xxhash64(key), parts(own)).cast("int")) \
            .withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), parts(other) - 1))).drop("p_parts", "s_parts")

    return dealt(probes, "p_key", "p", "s"), dealt(stations, "s_key", "s", "p"), ["gram", "p_part", "s_part"]


def fuzzy_candidates(probes: DataFrame, probe_col: str, stations: DataFrame) -> DataFrame:
    """All (probe, station) pairs with similarity strictly above 0.4, with the similarity.

    ``probes``: distinct ``probe_col`` texts. ``stations``: station_id, station_name.
    Gram sets and prefixes are written once. Two sets can only be similar
    enough if their sizes are close and, from the first gram they share, enough
    grams are left on both sides; both are part of the join, so common grams
    make few pairs.
    """
    pg = write_table(probes.select(F.col(probe_col).alias("key"), trigrams(probe_col).alias("grams")).distinct()
                     .withColumn("n", F.size("grams")), "fuzzy-probes")
    sg = write_table(stations.select("station_id", "station_name", trigrams("station_name").alias("grams"))
                     .withColumn("key", F.col("station_id")).withColumn("n", F.size("grams")), "fuzzy-stations")
    freq = write_table(pg.select(F.explode("grams").alias("gram"))
                       .unionByName(sg.select(F.explode("grams").alias("gram")))
                       .groupBy("gram").agg(F.count(F.lit(1)).alias("freq")), "fuzzy-grams")
    pp = write_table(_prefixes(pg, freq), "fuzzy-probe-prefixes").select(
        "gram", F.col("key").alias("p_key"), F.col("n").alias("p_n"), F.col("at").alias("p_at"))
    sp = write_table(_prefixes(sg, freq), "fuzzy-station-prefixes").select(
        "gram", F.col("key").alias("s_key"), F.col("n").alias("s_n"), F.col("at").alias("s_at"))
    size_ok = F.least("p_n", "s_n") * T_DEN >= F.greatest("p_n", "s_n") * T_NUM
    # The pair's first shared gram is at these places; at most the rest of the shorter tail can be shared too.
    left = F.least(F.col("p_n") - F.col("p_at"), F.col("s_n") - F.col("s_at"))
    place_ok = left * T_DEN >= (F.col("p_n") + F.col("s_n") - left) * T_NUM
    pp, sp, on = dealt_by_gram(pp, sp)
    pairs = pp.join(sp, on).filter(size_ok).groupBy("p_key", "s_key").agg(
        F.min(F.struct("p_at", "s_at", "p_n", "s_n")).alias("m")).select("p_key", "s_key", "m.*").filter(place_ok) \
        .select("p_key", "s_key")
    full = (pairs.join(pg.select(F.col("key").alias("p_key"), "grams", "n"), "p_key")
            .join(sg.select(F.col("key").alias("s_key"), "station_name", F.col("grams").alias("s_grams"),
                            F.col("n").alias("s_n")), "s_key"))
    verified = (full.withColumn("n_shared", F.size(F.array_intersect("grams", "s_grams")))
                .withColumn("n_union", F.col("n") + F.col("s_n") - F.col("n_shared"))
                .filter(F.col("n_shared") * T_DEN > F.col("n_union") * T_NUM))
    return verified.select(F.col("p_key").alias(probe_col), F.col("s_key").alias("station_id"), "station_name", "n_shared", "n_union",
                           (F.col("n_shared") / F.col("n_union")).alias("similarity"))


def fuzzy_best_match(probes: DataFrame, probe_col: str, stations: DataFrame) -> DataFrame:
    """Best station per probe: highest similarity, then smallest name, then smallest id."""
    cand = fuzzy_candidates(probes, probe_col, stations)
    rank = F.struct(-F.col("similarity"), F.col("station_name"), F.col("station_id"))
    best = cand.groupBy(probe_col).agg(
        F.min_by(F.struct("station_id", "station_name", "similarity"), rank).alias("b"))
    return best.select(probe_col, "b.station_id", "b.station_name", "b.similarity")


def pair_similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Row-wise trigram similarity of two text columns, with shared and union counts."""
    ga, gb = trigrams(a), trigrams(b)
    shared = F.size(F.array_intersect(ga, gb))
    return pairs.select(a, b, shared.alias("n_shared"),
                        (F.size(ga) + F.size(gb) - shared).alias("n_union"),
                        similarity_from_sets(ga, gb).alias("similarity"))


def resolve_names(raw: DataFrame, stations: DataFrame, overrides: DataFrame,
                  prefix: str = NAME_PREFIX, name_col: str = "raw_name") -> DataFrame:
    """Resolve each distinct raw name once: ``raw_name, station_id, method, reason``.

    Override hit -> that station (a missing or ambiguous target is final).
    Else prefix strip, exact name (ambiguous if two stations share it), else
    fuzzy best above 0.4. ``station_id`` is null and ``reason`` set when
    unresolved.
    """
    names = raw.select(F.col(name_col).alias("raw_name")).filter(
        F.nullif(F.col("raw_name"), F.lit("")).isNotNull()).distinct()
    index = stations.groupBy("station_name").agg(F.count(F.lit(1)).alias("n_st"),
                                                 F.min("station_id").alias("idx_id"))
    base = (names.join(overrides.select("raw_name", "override_name"), "raw_name", "left")
            .withColumn("search_name", strip_prefix("raw_name", prefix))
            .withColumn("lookup", F.coalesce(F.col("override_name"), F.col("search_name"))))
    looked = write_table(base.join(index, F.col("lookup") == F.col("station_name"), "left").drop("station_name"),
                         "resolve-looked-up")
    via_override = F.col("override_name").isNotNull()
    need_fuzzy = looked.filter(~via_override & F.col("n_st").isNull() & F.col("search_name").isNotNull())
    fuzzy = fuzzy_best_match(need_fuzzy.select("search_name"), "search_name", stations) \
        .select("search_name", F.col("station_id").alias("fz_id"))
    out = looked.join(fuzzy, "search_name", "left")
    method = (F.when(via_override & (F.col("n_st") == 1), F.lit("override"))
              .when(~via_override & (F.col("n_st") == 1), F.lit("exact"))
              .when(~via_override & F.col("n_st").isNull() & F.col("fz_id").isNotNull(), F.lit("fuzzy")))
    station_id = (F.when(F.col("n_st") == 1, F.col("idx_id"))
                  .when(~via_override & F.col("n_st").isNull(), F.col("fz_id")))
    reason = (F.when(via_override & F.col("n_st").isNull(), F.lit("override target missing"))
              .when(via_override & (F.col("n_st") > 1), F.lit("ambiguous override target"))
              .when(F.col("n_st") > 1, F.lit("ambiguous name"))
              .when(F.col("n_st").isNull() & F.col("fz_id").isNull(), F.lit("no match")))
    return out.select("raw_name", station_id.alias("station_id"), method.alias("method"), reason.alias("reason"))
