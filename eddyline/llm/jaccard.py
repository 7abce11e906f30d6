"""Operator 12, n-gram Jaccard join in the metric space of word-shingle sets.

Two documents link when ``|A n B| / |A u B|`` of their sets of distinct word
shingles is at least ``percent / 100``; the Jaccard distance ``d = 1 - J`` is a
metric, so distances to a few pivots bound all others.

* Equal sets collapse first (partial aggregate), so thousands of copies are one
  member.  Shingles are compared by 64-bit hash, whole sets by 128-bit digest.
* A member that cannot link is left out, exactly: sorted by hash, the first
  ``n - ceil(w n) + 1`` shingles of two members whose similarity is at least
  ``w`` share one, and of two that link they share more than ``(t - w) t n``
  (``t`` the link threshold, ``w`` that of the prefix).  Members whose
  prefix shingles occur in too few other prefixes go, twice over and again in each round.
* Pivots create Voronoi regions.  In each round the members still in no region
  elect pivots: whoever comes first among the holders of each of its prefix shingles, in the
  order of the fewest shingles of its own, so that the middle of a group is elected.  No two
  pivots of a round hold a prefix shingle in common (in the first round), so a hot group costs
  one row per member and shingle, not its square.  Every member still in no region whose distance
  to a pivot is at most ``3 r`` (``r = 1 - t``) is found with its exact distance (the places of the
  shingles that two prefixes share bound the difference of the sets, so few others are compared
  whole); at most ``r`` is a link; at most ``2 r`` ends that member's search, and its home is the
  nearest such pivot.  Later rounds elect among more and more parts of a shingle's holders, the
  last round makes all that remain pivots.
* Triangle-inequality windows: of two members that link, the one that got its home ``p`` first lies
  within ``2 r`` of it, so the other was still searching and lies within ``3 r`` of ``p``: both are in its window.
* In a window a member ``x`` stands for its difference ``x ^ p`` (what it lacks of ``p`` and what it
  has besides).  ``|x ^ y| = |x ^ p| + |y ^ p| - 2 |both|``, so members that link, and are not both
  linked with ``p``, must share parts of their differences; edits of one text that have nothing
  in common never meet, however many there are.  The differences are joined by their rarest
  ``|x| r / t + 1`` shingles, with the place of a shared one as a bound: first with a few leaders
  of each shingle's holders, then, where holders are in different components, all that are
  not in the most frequent one with the rest.
* No link between different components is left untried, so the components are
  exact.  They come from distributed star contraction.  Pairs carry only ids;
  the sets of the members left are made again from their texts for the exact
  check, and no group is gathered into one task.

Nulls and ties: a null or blank text has an empty set, links with nothing and is
its own component.  A text of fewer words is one shingle.  Rows of a null id take
part; a component id is the smallest non-null id reachable, null if there is
none.  Repeated rows and ids each keep their row; an empty table gives no row.
A text's shingle hashes are one array in one task, however long the text.  Other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import components, materialize
from eddyline.llm.simhash import shingle_hashes
from eddyline.session import settings_for_start

WORDS = 3                 # words of a shingle, from the contract
PERCENT = 90              # similarity of a link, from the contract
PARTS = (1, 8, 64, 512)   # parts of a shingle's holders that elect, by round; then all are pivots
BUCKETS = 1 << 20         # counters of shingles, for the order of a set
LEADERS = 4               # leaders of a shingle's holders in a window
SHARE_ROWS = 1000         # fewer shared shingles of windows are not worth a pass with leaders
BROADCAST_ROWS = 200_000  # text hashes small enough to broadcast


def shingle_set(raw: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending (unsigned)."""
    found = list(shingle_hashes(raw, words))
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """Elements of a set of ``n`` of which a set at least so similar holds one."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _sketches(words: int, percent: int | None):
    """``id, mark, text`` to ``id, mark, n, d1, d2, hashes``: the prefix for
    ``percent``, or (None) the whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                n, digests, held = [], [], []
                for raw in part.column(2).cast(pa.binary()).to_pylist():
                    s = shingle_set(raw or b"", words)
                    n.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    held.append((s if percent is None else s[:prefix_length(len(s), percent)]).view(np.int64))
                d = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                at = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()),
                     pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1])),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(held)))],
                    ["id", "mark", "n", "d1", "d2", "hashes"])
    return run


def _sketched(rows: DataFrame, words: int, percent: int | None) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_sketches(words, percent),
                           f"id {kind}, mark long, n long, d1 long, d2 long, hashes array<long>")


def _need(n: Column, percent: int, window: int) -> Column:
    """Shingles of the prefix for ``window`` that a member of ``n`` shares with whoever it links with."""
    return F.floor(n * percent * (percent - window) / 10000) + 1


def _rare_first(sets: DataFrame) -> DataFrame:
    """``sets`` with only the first ``keep`` of their ``hashes`` (the last two columns), those of rare
    buckets first.  Any one order of all shingles gives the same links; a table of ``BUCKETS`` counters
    makes a good one."""
    spark = sets.sparkSession
    shift = 64 - (BUCKETS.bit_length() - 1)
    counts = (sets.select(F.explode("hashes").alias("h"))
              .groupBy(F.shiftrightunsigned("h", shift).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n")))
    got = counts.toArrow()                                   # at most BUCKETS rows
    level = np.zeros(BUCKETS, dtype=np.uint8)
    level[got.column("b").to_numpy()] = np.log2(got.column("n").to_numpy()).astype(np.uint8)
    shared = spark.sparkContext.broadcast(level)
    names = sets.columns
    assert names[-2:] == ["keep", "hashes"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            lists = b.column(len(names) - 1)
            at = lists.offsets.to_numpy()
            h = lists.values.to_numpy().view(np.uint64)
            kept = []
            for lo, hi, keep in zip(at[:-1].tolist(), at[1:].tolist(), b.column(len(names) - 2).to_pylist()):
                s = h[lo:hi]
                first = np.lexsort((s, table[(s >> np.uint64(shift)).astype(np.int64)]))
                kept.append(s[first[:keep]].view(np.int64))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in kept]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(names) - 1)), pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(kept) if kept else [], pa.int64()))], names)
    return sets.mapInArrow(cut, sets.schema)


def _free(spark) -> None:
    """Let Spark's cleaner remove the checkpoints of steps that are over; it learns of them
    when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def _able(keys: DataFrame, sizes: DataFrame, percent: int, window: int) -> DataFrame:
    """``sizes`` without members that share too few of the ``keys(key, rid)`` to link."""
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    held = keys.select("key", "rid").join(often, "key").groupBy("rid").agg(F.count(F.lit(1)).alias("c"))
    return materialize(held.join(sizes, "rid").where(F.col("c") >= _need(F.col("n"), percent, window))
                       .select(*sizes.columns))


def _keys(prefixes: DataFrame, members: DataFrame) -> DataFrame:
    """``place, key, rid`` of the ``prefixes(rid, hashes)`` of the members; they are chosen before the rows are made."""
    chosen = prefixes.select("rid", "hashes").join(members.select("rid"), "rid", "left_semi")
    return chosen.select(F.posexplode("hashes").alias("place", "key"), "rid")


def _shared(keys: DataFrame) -> DataFrame:
    """The keys that two members hold."""
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return materialize(keys.join(often, "key").select("key", "rid", "place"))


def _prefix(n: Column, percent: int) -> Column:
    """:func:`prefix_length` of a column."""
    return n - F.ceil(n * percent / 100) + 1


def _candidates(keys: DataFrame, marked: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``x, p`` of a member and a pivot that may have similarity ``percent``.

    Up to the last shingle that their prefixes share, at places ``i`` and ``j`` (from 0), ``c`` are
    shared, so ``i + j + 2 - 2 c`` shingles are in one set only; behind it, the rest of the prefix that
    ends first is too.  A pair with more such shingles than the similarity admits is left out."""
    shared = (keys.join(marked, "key").where("rid <> p").groupBy(F.col("rid").alias("x"), "p")
              .agg(F.count(F.lit(1)).alias("c"), F.max("place").alias("i"), F.max("mark").alias("j")))
    nx, np_ = F.col("nx"), F.col("np")
    rest = F.least(_prefix(nx, percent) - F.col("i"), _prefix(np_, percent) - F.col("j")) - 1
    apart = F.col("i") + F.col("j") + 2 - 2 * F.col("c") + rest
    return (shared.join(sizes.select(F.col("rid").alias("x"), F.col("n").alias("nx")), "x")
            .join(sizes.select(F.col("rid").alias("p"), F.col("n").alias("np")), "p")
            .where((100 * F.least(nx, np_) >= percent * F.greatest(nx, np_))
                   & (apart * (100 + percent) <= (100 - percent) * (nx + np_))).select("x", "p"))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs(x, p)`` with ``both`` and ``either`` (sizes of intersection and
    union), those of similarity ``percent`` or more."""
    a = sets.select(F.col("rid").alias("x"), F.col("n").alias("nx"), F.col("hashes").alias("hx"))
    b = sets.select(F.col("rid").alias("p"), F.col("n").alias("np"), F.col("hashes").alias("hp"))
    met = (pairs.join(a, "x").join(b, "p")
           .where(100 * F.least("nx", "np") >= percent * F.greatest("nx", "np"))
           .withColumn("both", F.size(F.array_intersect("hx", "hp")).cast("bigint"))
           .withColumn("either", F.col("nx") + F.col("np") - F.col("both")))
    return met.select("x", "p", "both", "either").where(100 * F.col("both") >= percent * F.col("either"))


def _pivots(keys: DataFrame, sizes: DataFrame, window: int, seed: int, parts: int | None) -> DataFrame:
    """``p``: members that lead each of their keys among a part of its holders.  Members of which
    the largest share of the prefix is in ``keys`` come first: they have the fewest edits of their own."""
    if parts is None:
        return keys.select(F.col("rid").alias("p")).distinct()
    held = keys.groupBy("rid").agg(F.count(F.lit(1)).alias("held"))
    own = F.floor(100 * (_prefix(F.col("n"), window) - F.col("held")) / F.col("n")).alias("own")
    ranked = keys.select("key", "rid").join(held.join(sizes, "rid").select("rid", own), "rid")
    led = (ranked.groupBy("key", F.pmod(F.xxhash64("rid", F.lit(seed + 1)), F.lit(parts)).alias("part"))
           .agg(F.min(F.struct("own", F.xxhash64("rid", F.lit(seed)).alias("order"), F.col("rid").alias("p"))).alias("low"))
           .groupBy(F.col("low.p").alias("p")).agg(F.count(F.lit(1)).alias("led")))
    return led.join(held.withColumnRenamed("rid", "p"), "p").where("led = held").select("p")


def voronoi_pairs(prefixes: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int,
                  window: int) -> tuple[DataFrame, DataFrame]:
    """``x, p, both, either`` of pivots and the members of similarity ``window`` that were still
    searching, and ``x, p`` of members and their homes.  Of two members that link, either one is
    a pivot and the pair is there, or the home of one has both in its window."""
    cover = window + 100 - percent
    members, found, homes = sizes, [], []
    for i, parts in enumerate([*PARTS, None]):
        left = _shared(_keys(prefixes, members))
        pivots = materialize(_pivots(left, members, window, 2 * i, parts))
        marked = left.join(pivots, left.rid == pivots.p, "left_semi").select(
            "key", F.col("rid").alias("p"), F.col("place").alias("mark"))
        pairs = materialize(_candidates(left, marked, members, window))
        near = materialize(_similar(pairs, sets, window))
        found.append(near)
        inside = near.where(100 * F.col("both") >= cover * F.col("either"))
        at = (inside.join(pivots.select(F.col("p").alias("x")), "x", "left_anti").groupBy("x")
              .agg(F.max(F.struct((F.col("both") / F.col("either")).alias("like"), "p")).alias("top"))
              .select("x", F.col("top.p").alias("p")))
        homes.append(materialize(at))
        _free(sets.sparkSession)
        if parts is None:
            break
        done = homes[-1].select(F.col("x").alias("rid")).unionByName(pivots.select(F.col("p").alias("rid")))
        # A member with a home has met all that still searched: the rest need only meet one another.
        members = materialize(members.join(done, "rid", "left_anti"))
        members = _able(_keys(prefixes, members), members, percent, window)
        if members.isEmpty():
            break
    every, settled = found[0], homes[0]
    for near, at in zip(found[1:], homes[1:]):
        every, settled = every.unionByName(near), settled.unionByName(at)
    return every, settled


def _differences(pairs: DataFrame, homes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``x, p, n, linked, home, size, keep, hashes`` of the members of each window that has members
    not linked with its pivot: the first shingles of their differences from it."""
    linked = (100 * F.col("both") >= percent * F.col("either")).alias("linked")
    rows = pairs.join(homes.withColumn("home", F.lit(True)), ["x", "p"], "left").select(
        "x", "p", linked, F.coalesce("home", F.lit(False)).alias("home"))
    # A window matters if it is a home and has a member not linked with its pivot.
    open_ = rows.groupBy("p").agg(F.max("home").alias("h"), F.min("linked").alias("l")).where("h and not l").select("p")
    rows = materialize(rows.join(open_, "p", "left_semi"))
    a = sets.select(F.col("rid").alias("x"), "n", F.col("hashes").alias("hx"))
    b = sets.select(F.col("rid").alias("p"), F.col("hashes").alias("hp"))
    apart = F.concat(F.array_except("hx", "hp"), F.array_except("hp", "hx"))
    rows = (rows.join(a, "x").join(b, "p").select("x", "p", "n", "linked", "home", apart.alias("apart"))
            .withColumn("size", F.size("apart").cast("bigint"))
            .withColumn("keep", F.least("size", F.floor(F.col("n") * (100 - percent) / percent) + 1)))
    # A shingle of one window is not that of another.
    mine = F.xxhash64("p")
    hashes = F.transform("apart", lambda h: h.bitwiseXOR(mine)).alias("hashes")
    return materialize(_rare_first(materialize(rows.select("x", "p", "n", "linked", "home", "size", "keep", hashes))))


def _may_link(percent: int) -> Column:
    """Whether the members ``a`` and ``b`` of a window, whose differences share a shingle at their
    places, may link if it is the first they share."""
    size = F.col("a.size") + F.col("b.size")
    most = F.floor((100 - percent) * (F.col("a.n") + F.col("b.n")) / (100 + percent))
    rest = F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place"))
    return ((F.col("a.x") != F.col("b.x")) & (F.col("a.home") | F.col("b.home"))
            & ~(F.col("a.linked") & F.col("b.linked")) & (2 * rest >= size - most))


def _window_links(pairs: DataFrame, homes: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``links`` and those between members of a window of different components found so far."""
    differ = _differences(pairs, homes, sets, percent)
    often = (differ.select(F.explode("hashes").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("key"))
    held = differ.select("x", "n", "linked", "home", "size", F.posexplode("hashes").alias("place", "key"))
    held = materialize(held.join(often, "key"))
    rows = held.count()
    if not rows:
        return links
    pair = (F.least("a.x", "b.x").alias("x"), F.greatest("a.x", "b.x").alias("p"))
    # A few leaders of each shingle's holders first, so that a group within a window is one component.
    if rows >= SHARE_ROWS:
        part = F.pmod(F.xxhash64("x"), F.lit(LEADERS))
        lead = (held.where(~F.col("linked")).groupBy("key", part.alias("part"))
                .agg(F.min(F.struct("size", "x", "n", "linked", "home", "place")).alias("low")).select("key", "low.*"))
        met = held.alias("a").join(lead.alias("b"), (F.col("a.key") == F.col("b.key")) & _may_link(percent))
        met = materialize(met.select(*pair).distinct())
        links = materialize(links.unionByName(_similar(met, sets, percent).select("x", "p")))
    label = components(links.select(F.col("x").alias("a"), F.col("p").alias("b")))
    known = held.join(label, held.x == label.node, "left").select(*held.columns, F.coalesce("label", "x").alias("label"))
    # Shingles whose holders are of one component are done; of the others, all holders meet those
    # that are not of the most frequent one.
    known = materialize(known)
    most = (known.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("c", "label")).alias("top"))
            .where("labels > 1").select("key", F.col("top.label").alias("most")))
    known = materialize(known.join(most, "key"))
    met = known.where("label <> most").alias("a").join(
        known.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label")) & _may_link(percent))
    met = materialize(met.select(*pair).distinct())
    return materialize(links.unionByName(_similar(met, sets, percent).select("x", "p")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``docs``."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    # The steps here are written out one by one, so a step's shuffle files can go when it is over.
    with settings_for_start(docs.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return _jaccard_components(docs, id_col, text_col, words, percent)


def _jaccard_components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    first_cut = 2 * percent - 100
    window = max(3 * percent - 200, 1)
    spark = docs.sparkSession
    raw = docs.select(F.col(f"`{id_col}`").alias("id"),
                      F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("mark"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    made = materialize(_sketched(raw, words, first_cut))
    rows = materialize(made.drop("hashes"))
    first = (made.where("n > 0").groupBy("d1", "d2")
             .agg(F.min("id").alias("low"), F.min("mark").alias("mark"), F.first("n").alias("n"),
                  F.first("hashes").alias("hashes")))
    first = materialize(first.withColumn("rid", F.monotonically_increasing_id()))
    member = materialize(first.drop("hashes"))
    sizes = _able(first.select(F.explode("hashes").alias("key"), "rid"),
                  member.select("rid", "n", "mark", "d1", "d2"), percent, first_cut)
    del made, first
    _free(spark)
    # The whole sets of the members left, made again from their texts.
    marks = sizes.select("mark").distinct()
    if sizes.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    again = _sketched(raw.join(marks, "mark", "left_semi").select("id", "mark", "text"), words, None)
    whole = (again.select("d1", "d2", "hashes").join(sizes.select("d1", "d2", "rid", "n"), ["d1", "d2"])
             .groupBy("rid").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")))
    sets = materialize(whole)
    rare = materialize(_rare_first(sets.select("rid", _prefix(F.col("n"), window).alias("keep"), "hashes")))
    places = rare.select(F.posexplode("hashes").alias("place", "key"), "rid")
    sizes = _able(places, sizes.select("rid", "n"), percent, window)
    sizes = _able(_keys(rare, sizes), sizes, percent, window)
    sets = materialize(sets.join(sizes.select("rid"), "rid", "left_semi"))
    rare = materialize(rare.select("rid", "hashes").join(sizes.select("rid"), "rid", "left_semi"))
    del whole, again, places
    _free(spark)
    pairs, homes = voronoi_pairs(rare, sizes, sets, percent, window)
    links = materialize(pairs.where(100 * F.col("both") >= percent * F.col("either")).select("x", "p"))
    links = _window_links(pairs, homes, links, sets, percent)
    label = components(links.select(F.col("x").alias("a"), F.col("p").alias("b")))
    named = (member.select("d1", "d2", "rid", "low").join(label, member.rid == label.node, "left")
             .select("d1", "d2", "low", F.coalesce("label", "rid").alias("label")))
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
    groups = named.join(lows, "label").select("d1", "d2", "component_id")
    linked = rows.where("n > 0").join(groups, ["d1", "d2"])
    return linked.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id").unionByName(
        rows.where("n = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                   F.col("id").alias("component_id")))
