"""Duplicates: winners of groups (W1 to W4), the order-dependent filter (J1 to J4), the batch over all sources (J13) and its statistics.

Every function wants an `ordinal` (the input order): among equals the first wins. Winners are max_by aggregates with a partial step, so a hot key is folded on
the map side and no group is ever sorted in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korbwerk.functions.classify import job_family
from korbwerk.functions.text import blank, company_key, postcode, ustrip
from korbwerk.plans.checkpoint import materialise
from korbwerk.schema import category_priority

UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
LINKS = ("ba_job_url", "link_bewerbung", "link_bewerbung_externe")
TOKEN_LINKS = (*LINKS, "link_bewerbung_efektif")


def lowered(name: str) -> Column:
    return F.lower(ustrip(F.col(name)))


def secondary_key() -> Column:
    """Hash of company, title, city, postcode and the description's begin."""
    parts = [lowered("nama_perusahaan"), lowered("jenis_ausbildung"), lowered("posisi_kota"), postcode(F.col("alamat_detail")), F.lower(ustrip(F.substring(blank(F.col("detail_deskripsi")), 1, 200)))]
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def near_key() -> Column:
    """Company, title, city and address; null unless all are there."""
    parts = [lowered(c) for c in ("nama_perusahaan", "jenis_ausbildung", "posisi_kota", "alamat_detail")]
    return F.when(reduce(lambda a, b: a & b, (p != "" for p in parts)), F.concat_ws("\u0001", *parts))


def cross_key() -> Column:
    """Company, city and job family; null unless company and city are there."""
    company, city = company_key(F.col("nama_perusahaan")), lowered("posisi_kota")
    return F.when((company != "") & (city != ""), F.concat_ws("\u0001", company, city, job_family(F.col("jenis_ausbildung"), F.col("detail_deskripsi"))))


def rank(priorities: dict[str, int] | None = None) -> Column:
    """Priority of the category, length of the description, time of the scrape; then the first."""
    return F.struct(category_priority(F.col("category_id"), priorities).alias("p"), F.length(blank(F.col("detail_deskripsi"))).alias("n"), blank(F.col("scraped_at")).alias("t"), (-F.col("ordinal")).alias("o"))


def winners(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """One row of each key: the one of highest order. Adds `_size` (rows of the key) and `_categories` (more than one category). The aggregate carries ordinals only; rows are fetched by them."""
    best = df.groupBy(key.alias("_key")).agg(F.max_by("ordinal", order).alias("ordinal"), F.count("*").alias("_size"), (F.min(blank(F.col("category_id"))) != F.max(blank(F.col("category_id")))).alias("_categories"))
    return df.join(best.drop("_key"), "ordinal").select(*df.columns, "_size", "_categories")


def deduplicate(listings: DataFrame, priorities: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """What is kept, and one row of counts. Phases: same reference; same hash where there is no reference; near key with more than one reference."""
    ref = ustrip(F.col("referenznummer"))
    order = rank(priorities)
    # both first phases in one pass: a row has a reference or is known by its hash
    key = F.when(ref != "", F.concat(F.lit("r"), ref)).otherwise(F.concat(F.lit("h"), secondary_key()))
    first = winners(listings.where(ref.isNotNull()), key, order)
    remaining = materialise(first.withColumn("_phase", F.when(ref != "", 1).otherwise(2)))
    keyed = remaining.withColumn("_near", near_key())
    groups = keyed.where("_near is not null").groupBy("_near").agg(F.max_by("ordinal", order).alias("_winner"), F.count("*").alias("_n"), (F.min(ref) != F.max(ref)).alias("_refs"))
    crowded = groups.where("_n > 1 and _refs")
    kept = keyed.join(crowded.withColumnRenamed("_near", "_k"), spread("_near") == F.col("_k"), "left").where(F.col("_winner").isNull() | (F.col("_winner") == F.col("ordinal")))
    stats = remaining.agg(
        F.coalesce(F.sum("_size"), F.lit(0)).alias("input_total"),
        F.coalesce(F.sum(F.when((F.col("_phase") == 1) & F.col("_categories"), F.col("_size") - 1)), F.lit(0)).alias("removed_by_refnr_cross_category"),
        F.coalesce(F.sum(F.when((F.col("_phase") == 1) & ~F.col("_categories"), F.col("_size") - 1)), F.lit(0)).alias("removed_by_refnr_within_category"),
        F.coalesce(F.sum(F.when(F.col("_phase") == 2, F.col("_size") - 1)), F.lit(0)).alias("removed_by_secondary_key"),
    ).crossJoin(crowded.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("removed_by_near_duplicate")))  # one row each
    removed = F.col("removed_by_refnr_cross_category") + F.col("removed_by_refnr_within_category") + F.col("removed_by_secondary_key") + F.col("removed_by_near_duplicate")
    return kept.select(*listings.columns), stats.withColumn("output_total", F.col("input_total") - removed)


def public_family() -> Column:
    """F16, Q1: every row that is neither of the two boards nor has their ids."""
    return ~third_party() & ~ustrip(F.col("referenznummer")).rlike("^(AD-|MAD-)")


def third_party() -> Column:
    return lowered("sumber_data").isin("ausbildung_de", "meine_ausbildung_de")


def url_tokens(master: DataFrame) -> DataFrame:
    """Whole links and the UUIDs in them, of more than 8 characters."""
    links = F.array(*(lowered(c) for c in TOKEN_LINKS))
    tokens = F.array_union(links, F.flatten(F.transform(links, lambda x: F.regexp_extract_all(x, F.lit(UUID), F.lit(0)))))
    return master.select(F.explode(tokens).alias("token")).where(F.length("token") > 8).distinct()


#: Bits of a filter of pieces for each piece, tests of a piece, and bits at most (8 MB, sent with the tasks). A fuller filter lets more pieces through; none is lost.
PIECE_BITS, PIECE_TESTS, MOST_BITS = 32, 3, 1 << 26


def among(pieces: DataFrame) -> Column:
    """Whether the column `piece` may be one of `pieces`: a Bloom filter as wide as their number asks for, built by one aggregate and written once."""
    wide = -(-min(max(pieces.count() * PIECE_BITS, 1024), MOST_BITS) // 64) * 64
    hashes = [F.pmod(F.xxhash64("piece", F.lit(i)), F.lit(wide)) for i in range(PIECE_TESTS)]
    placed = pieces.select(F.explode(F.array(*hashes)).alias("at")).select(F.floor(F.col("at") / 64).alias("word"), F.expr("shiftleft(1L, int(at % 64))").alias("bits"))
    empty = pieces.sparkSession.range(wide // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    filled = placed.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bits = materialise(filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits"))).scalar()
    return reduce(lambda a, b: a & b, (F.getbit(F.element_at(bits, (F.floor(h / 64) + 1).cast("int")), (h % 64).cast("int")) == 1 for h in hashes))


def holds_token(new: DataFrame, tokens: DataFrame) -> DataFrame:
    """Ordinals of the rows one of whose links contains a token.

    A token is found by one of its 9-character pieces: the links' pieces are joined with them by key, and the whole token is then tested where they meet. So the join is by key, and nothing is compared
    all with all. Common beginnings (scheme and host) meet often; a token is keyed by its rarest piece instead, counted over all links. Only pieces that a filter of the tokens' pieces lets through are
    counted, and only those that a filter of the rarest ones lets through are shuffled with their links: a link without a token sends hardly a row.
    """
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.length("link") - 8, F.lit(1))), lambda i: F.substring(F.col("link"), i, F.lit(9)))
    links = new.select("ordinal", F.explode(F.array_distinct(F.array(*(lowered(c) for c in LINKS)))).alias("link")).where(F.length("link") > 8)
    by_piece = links.select("ordinal", "link", F.explode(F.array_distinct(pieces)).alias("piece"))
    token_pieces = F.transform(F.sequence(F.lit(1), F.length("token") - 8), lambda i: F.substring(F.col("token"), i, F.lit(9)))
    of_tokens = materialise(tokens.select("token", F.explode(F.array_distinct(token_pieces)).alias("piece")))
    often = by_piece.where(among(of_tokens.select("piece"))).groupBy("piece").agg(F.count("*").alias("n"))
    rarest = materialise(of_tokens.join(often, "piece", "left").groupBy("token").agg(F.min_by(F.col("piece"), F.struct(F.coalesce("n", F.lit(0)), F.col("piece"))).alias("piece")))
    met = by_piece.where(among(rarest.select("piece"))).join(rarest, "piece")
    return met.where(F.contains("link", F.col("token"))).select("ordinal").distinct()


KEYS = ("ref", "near", "cross")


def spread(name: str) -> Column:
    """A key for joins: what is null, and so meets nothing, gets a value of its own, so that such rows don't all go to one task."""
    return F.coalesce(F.col(name).cast("string"), F.concat(F.lit("\u0000"), F.col("ordinal").cast("string")))


def with_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"_ref": F.nullif(ustrip(F.col("referenznummer")), F.lit("")), "_near": near_key(), "_cross": cross_key()})


#: Undecided rows, or rows of a component, up to which one task folds them in order; rounds of contraction before components are looked for.
FOLD_ROWS, ROUNDS = 200_000, 3


def greedy(rows: DataFrame, names: tuple[str, ...] = tuple(f"_{k}" for k in KEYS), fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Ordinals of the rows that are accepted: no accepted row before them shares one of their keys.

    A row that is the first undecided one under each of its keys is accepted. A row that only one undecided row stands before is accepted if and only if that one isn't, so rows that hang on each other
    in a chain are decided together, by doubling pointers; and below such a row its key is taken in any case. What shares a key with an accepted row is rejected. Rounds consist of aggregates and joins
    by key (pairs are never made). A chain of n rows takes log2(n) doublings. When `fold_rows` or fewer are undecided, one task folds them in order. What more than that is undecided after ROUNDS rounds falls
    into components of rows that share keys; each of up to `fold_rows` rows is folded by one task, the larger ones go on by rounds. Null keys meet nothing. Ordinals must be distinct.
    """
    tagged = F.array_compact(F.array(*(F.concat(F.lit(f"{i}:"), F.col(k).cast("string")) for i, k in enumerate(names))))
    rows = rows.select("ordinal", tagged.alias("k"))
    accepted, done = [rows.where(F.size("k") == 0).select("ordinal")], 0
    flat = materialise(rows.select("ordinal", F.explode("k").alias("k")))
    while left := flat.select("ordinal").distinct().count():
        if done and left <= fold_rows:
            accepted.append(materialise(flat.withColumn("root", F.lit(0).cast("long")).select("root", "ordinal", "k").coalesce(1).sortWithinPartitions("ordinal").mapInArrow(fold_in_order, "ordinal long")))
            break
        done += 1
        now, flat = fold_components(flat, fold_rows) if done % (ROUNDS + 1) == 0 else decide(flat)
        accepted.append(now)
    return reduce(DataFrame.unionByName, accepted)


def decide(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: ordinals that are accepted, and the keys (ordinal, k) of the rows that are still undecided."""
    first = flat.groupBy("k").agg(F.min("ordinal").alias("first"))
    placed = flat.join(first, "k")
    second = placed.where("ordinal > first").groupBy("k").agg(F.min("ordinal").alias("second"))
    # what stands before a row under a key: nothing, one row (`head`), or more
    marks = placed.join(second, "k", "left").select("ordinal", "k", F.when(F.col("ordinal") == F.col("second"), F.col("first")).alias("head"), F.coalesce(F.col("ordinal") > F.col("second"), F.lit(False)).alias("later"))
    marks = materialise(marks)
    kinds = materialise(marks.groupBy("ordinal").agg(F.min("head").alias("head"), F.max("head").alias("other"), F.max("later").alias("later")))
    free = kinds.where("not later and head is null").select("ordinal")
    hung = kinds.where("not later and head = other")
    chain = chase(hung.select("ordinal", "head", F.lit(True).alias("odd")))
    even = chain.where(~F.col("odd")).join(free.withColumnRenamed("ordinal", "head"), "head", "left_semi").select("ordinal")
    now = materialise(free.unionByName(even))
    taken = marks.join(now, "ordinal", "left_semi").select("k", F.lit(True).alias("for_all"))
    # of a row and the one that hangs on it alone, one is accepted: their key is taken for all later rows
    hanging = marks.where("head is not null").join(hung.select("ordinal"), "ordinal", "left_semi").select("k", F.lit(False).alias("for_all"))
    closed = taken.unionByName(hanging).groupBy("k").agg(F.max("for_all").alias("for_all"))
    gone = marks.join(closed, "k").where("for_all or later").select("ordinal").distinct()
    return now, materialise(marks.select("ordinal", "k").join(gone, "ordinal", "left_anti"))


def chase(links: DataFrame) -> DataFrame:
    """ordinal, head and whether an odd number of steps leads there, for rows that each hang on one other: pointers are doubled until every head hangs on nothing."""
    own = links
    while True:
        other = own.select(F.col("ordinal").alias("head"), F.col("head").alias("_head"), F.col("odd").alias("_odd"))
        if own.join(other, "head", "left_semi").isEmpty():
            return own
        step = own.join(other, "head", "left")
        own = materialise(step.select("ordinal", F.coalesce("_head", "head").alias("head"), F.when(F.col("_head").isNull(), F.col("odd")).otherwise(F.col("odd") != F.col("_odd")).alias("odd")))


def fold_components(flat: DataFrame, fold_rows: int) -> tuple[DataFrame, DataFrame]:
    """Ordinals that are accepted in components of up to `fold_rows` rows, and the keys of the rows of larger ones."""
    first = flat.groupBy("k").agg(F.min("ordinal").alias("b"))
    found = components(flat.join(first, "k").where("ordinal > b").select(F.col("ordinal").alias("a"), "b"))
    named = materialise(flat.join(found, F.col("ordinal") == F.col("node"), "left").select(F.coalesce("root", "ordinal").alias("root"), "ordinal", "k"))
    large = named.groupBy("root").agg(F.count_distinct("ordinal").alias("n")).where(F.col("n") > fold_rows).select("root")
    small = named.join(large, "root", "left_anti").repartition("root").sortWithinPartitions("root", "ordinal")
    return materialise(small.mapInArrow(fold_in_order, "ordinal long")), materialise(named.join(large, "root", "left_semi").select("ordinal", "k"))


def fold_in_order(batches):
    """Ordinals of accepted rows. batches: component, ordinal and key, by component and ordinal."""
    import pyarrow as pa

    component = row = None
    taken, own, out = set(), [], []
    for batch in batches:
        for root, ordinal, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ordinal != row or root != component:
                if own and taken.isdisjoint(own):
                    taken.update(own)
                    out.append(row)
                taken = taken if root == component else set()
                component, row, own = root, ordinal, []
            own.append(key)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["ordinal"])
        out = []
    if own and taken.isdisjoint(own):
        yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64())], ["ordinal"])


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that can be reached) of all nodes that edges (a, b) join. In turn, the larger neighbours of a node are hung on its smallest one, and all its smaller ones too, until nothing changes."""
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        ways = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        up = ways.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
        now = materialise(down.distinct())
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark


def filter_against(new: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `new` that neither the master nor an accepted earlier row has, and the others, marked."""
    left, known = with_keys(new), with_keys(master)
    for k in KEYS:
        left = left.join(known.where(F.col(f"_{k}").isNotNull()).select(F.col(f"_{k}").alias("_k")).distinct(), spread(f"_{k}") == F.col("_k"), "left_anti")
    left = left.join(holds_token(new, url_tokens(master)), "ordinal", "left_anti")
    accepted = materialise(greedy(left))
    unique = new.join(accepted, "ordinal", "left_semi").select(*new.columns)
    refs = known.select(F.col("_ref").alias("_known")).where("_known is not null").distinct()
    rejected = new.join(accepted, "ordinal", "left_anti").withColumn("_own", F.nullif(ustrip(F.col("referenznummer")), F.lit(""))).join(refs, spread("_own") == F.col("_known"), "left")
    marked = rejected.withColumn("is_duplicate_of_arbeitsagentur", F.lit(True)).withColumn("duplicate_of_refnr", blank(F.col("_known")))
    return unique, marked.select(*new.columns)


def mark_duplicates(new: DataFrame, master: DataFrame) -> DataFrame:
    """`new` with a mark and the reference of the first master row of the same near or cross key."""
    public, known = with_keys(master).where(public_family()), with_keys(master)
    out = with_keys(new)
    for k in ("near", "cross"):
        own = public.where(F.col(f"_{k}").isNotNull()).select(f"_{k}", F.lit(True).alias(f"_{k}_dup")).distinct()
        first = known.where(F.col(f"_{k}").isNotNull()).groupBy(f"_{k}").agg(F.min(F.struct(F.col("ordinal").alias("o"), blank(F.col("referenznummer")).alias("r"))).alias(f"_{k}_first"))
        sides = first.join(own, f"_{k}", "full_outer").withColumnRenamed(f"_{k}", "_k")
        out = out.join(sides, spread(f"_{k}") == F.col("_k"), "left").drop("_k")
    own_url = new.withColumns({"ba_job_url": F.when(blank(F.col("ausbildung_de_url")) != "", F.col("ausbildung_de_url")).otherwise(F.col("ba_job_url")), "link_bewerbung": F.lit(""), "link_bewerbung_externe": F.lit("")})
    by_url = holds_token(own_url, url_tokens(master.where(public_family()))).withColumn("_url_dup", F.lit(True))
    out = out.join(by_url, "ordinal", "left")
    dup = F.coalesce(F.col("_near_dup"), F.col("_cross_dup"), F.col("_url_dup"), F.lit(False))
    ref = F.coalesce(F.least("_near_first", "_cross_first")["r"], F.lit(""))
    return out.withColumn("is_duplicate_of_arbeitsagentur", dup).withColumn("duplicate_of_refnr", F.when(dup, ref).otherwise(blank(F.col("duplicate_of_refnr")))).select(*new.columns)


def deduplicate_all(listings: DataFrame, priorities: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """The public family is deduplicated, the third-party rows are filtered against it and deduplicated, the others pass. Also A8 to A10 in one row."""
    public, public_stats = deduplicate(listings.where(public_family()), priorities)
    public = materialise(public)
    unique, crossed = filter_against(listings.where(third_party()), public)
    boards, board_stats = deduplicate(unique, priorities)
    rest = listings.where(~public_family() & ~third_party())
    result = public.unionByName(boards).unionByName(rest)
    names = [c for c in public_stats.columns if c.startswith("removed")]
    stats = public_stats.unionByName(board_stats).agg(*(F.sum(c).alias(c) for c in names)).crossJoin(crossed.agg(F.count("*").alias("removed_by_cross_source")))  # one row each
    total = listings.agg(F.count("*").alias("input_total"))
    stats = total.crossJoin(stats)
    return result, stats.withColumn("output_total", F.col("input_total") - reduce(lambda a, b: a + b, (F.col(c) for c in (*names, "removed_by_cross_source"))))


def category_matrix(new: DataFrame, unique: DataFrame) -> DataFrame:
    """Rows of each category, those that the filter dropped, and those that it kept."""
    counts = counts_before_after(new, unique, "category_id")
    return counts.select(F.when(blank(F.col("category_id")) == "", "unknown").otherwise(F.col("category_id")).alias("category_id"), F.col("n_before").alias("scraped"), (F.col("n_before") - F.col("n_after")).alias("cross_duplicates"), F.col("n_after").alias("unique_new"))


def counts_before_after(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """Counts by a column on both sides, zero where one side has none."""
    a = before.groupBy(by).agg(F.count("*").alias("n_before"))
    b = after.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("n_after"))
    joined = a.join(b, F.col(by).eqNullSafe(F.col("_by")), "full_outer")
    return joined.select(F.coalesce(by, "_by").alias(by), F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
