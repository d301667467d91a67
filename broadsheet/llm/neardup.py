"""Near-duplicates by a signature-coordinate inverted join.

Every set of shingles gets a MinHash signature. A document is posted under each
(coordinate, value) pair of its signature. Two documents whose sets have a similarity of 0.8
agree in 51 of 64 coordinates on average and in fewer than ``AGREE`` = 34 with a probability
of about 3e-7, so documents that meet in at least 34 are the candidates.

* Coordinate values that no other document of a similar size has are no use and go first: sets
  whose sizes differ by more than the share cannot be linked. Of the rest each document posts its
  rarest ``shared - AGREE + 1`` only (prefix filter): two documents that agree in 34 coordinates
  still meet in one of these, and postings that half the corpus shares are mostly never made.
  Posts that then meet no other of a similar size go as well; only texts of documents that still
  have a post are read again.
* Documents that share a long passage meet in about as many coordinates as true near-duplicates.
  Those with postings therefore get 4,096 further coordinates, of which one bit each is kept.
  A link agrees in 3,686 of these bits on average. Pairs are counted over the first 256 bits
  where they meet (204 must agree) and then over all (3,576: a similarity of 0.746); a link
  fails one of the two counts with a probability of about 1e-6.
* Equal sets are one node throughout, whatever the number of copies.
* A posting is first read as a star: each member against one pivot, its smallest member; then,
  while many pairs are left, against pivots drawn for each posting anew, so a member that the
  first pivot missed meets up to as many others as it has postings. Then postings whose members are still in different components yield their pairs
  across components (and no others), each pair where it meets first, so no link between
  components is missed while members of one large group are never paired with each other.
* A candidate pair becomes a link only after its full sets were compared.

Null or word-less texts have an empty set and stay alone. Rows with a null id stay alone and
have no component. An id that several rows carry links through any of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import tables, words

COORDINATES = 64
AGREE = 34
#: Further coordinates, kept as one bit each in words of 64; how many bits must agree among
#: the leading words, which postings carry, and among all.
WORDS, LEADING = 64, 4
LEADING_AGREE, BITS_AGREE = 204, 3576
#: Coordinates made from one 32-bit value of a shingle.
FAMILY = 128
#: Set sizes are told apart in classes, of which a factor of 1 / share spans ``STEPS``; they come
#: round after ``CLASSES``, one bit each of a long.
STEPS, CLASSES = 4, 64
#: Stars are only repeated while postings would yield more pairs than this many times themselves.
PAIRS_PER_POSTING = 1
MOST_STARS = 2
#: What postings carry of a node.
CARRIED = ["n", *(f"w{i}" for i in range(LEADING))]
#: Tasks over which one pivot's members may be spread.
SPREAD = 256
SETS_AT_ONCE = 1 << 14
BITS_AT_ONCE = 1 << 9


def signature(shingles: np.ndarray) -> np.ndarray:
    """Per coordinate the smallest value of its own hash function, cut to 32 bits."""
    factors = words.seeds(COORDINATES, 11) | np.uint64(1)
    lowest = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), SETS_AT_ONCE):
        part = shingles[None, lo : lo + SETS_AT_ONCE] * factors[:, None]
        part ^= part >> np.uint64(29)
        part *= words.MULTIPLIER
        np.minimum(lowest, part.min(axis=1), out=lowest)
    return (lowest >> np.uint64(32)).astype(np.uint32).view(np.int32)


def bits(shingles: np.ndarray) -> np.ndarray:
    """One bit for each of the further coordinates, in words of 64.

    Each half of a scrambled shingle serves ``FAMILY`` coordinates, as multiples in 32 bits.
    """
    count = 64 * WORDS
    factors = (words.seeds(count, 12) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    factors = factors.reshape(-1, FAMILY, 1)
    lowest = np.full((len(factors), FAMILY), np.iinfo(np.uint32).max, np.uint32)
    salts = words.seeds(len(factors) // 2, 13)
    for lo in range(0, len(shingles), BITS_AT_ONCE):
        for at, salt in enumerate(salts):
            halves = words.mix(shingles[lo : lo + BITS_AT_ONCE] ^ salt).view(np.uint32).reshape(-1, 2)
            for half in (0, 1):
                row = 2 * at + half
                found = (np.ascontiguousarray(halves[:, half])[None, :] * factors[row]).min(axis=1)
                np.minimum(lowest[row], found, out=lowest[row])
    ones = (words.mix(lowest.ravel().astype(np.uint64)) >> np.uint64(63)).astype(np.uint8)
    return np.packbits(ones).view(np.int64)


def bit_words(texts: DataFrame, width: int) -> DataFrame:
    """id, set size n, the leading words w0, w1, ... and all words of ``bits`` of texts (id, text)."""
    names = CARRIED[1:]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for shingles in words.shingle_sets(batch.column("text"), width):
                sizes.append(len(shingles))
                found.append(bits(shingles))
            table = np.array(found, np.int64).reshape(-1, WORDS)
            columns = [pa.array(sizes, pa.int64()), *(pa.array(table[:, i]) for i in range(LEADING))]
            whole = pa.array(list(table), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *columns, whole], names=["id", "n", *names, "words"]
            )

    leading = ", ".join(f"{name} long" for name in names)
    return texts.mapInArrow(sketch, f"id long, n long, {leading}, words array<long>")


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key and signature of each row; texts stay in their task."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signs = [], [], []
            for found in words.shingle_sets(batch.column("text"), width):
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                signs.append(signature(found).tolist() if len(found) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(signs, pa.list_(pa.int32())),
                ],
                names=["doc_id", "n_shingles", "set_key", "sign"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        sketch, "doc_id long, n_shingles long, set_key binary, sign array<int>"
    )


def size_class(percent: int):
    """Sizes n of which one is at least ``percent`` of the other are at most ``STEPS`` classes apart.

    Classes a little too wide only keep more.
    """
    factor = 100 / min(max(percent, 1), 99)
    step = math.log(factor) / STEPS * (1 + 1e-9)
    return F.pmod(F.floor(F.ln("n") / step), F.lit(CLASSES)).cast("int")


def met(posts: DataFrame) -> DataFrame:
    """The posts (key, id, size) whose key has another of a similar size, and the key's number of posts.

    A key has one bit for each class of size; more posts than bits mean that some class has
    several, and then all its posts stay.
    """
    keys = (
        posts.groupBy("key")
        .agg(F.count("*").alias("members"), F.bit_or(F.expr("shiftleft(1L, size)")).alias("sizes"))
        .filter("members > 1")
    )
    apart = [*range(1, STEPS + 1), *range(CLASSES - STEPS, CLASSES)]
    near = " | ".join(f"shiftleft(1L, (size + {k}) % {CLASSES})" for k in apart)
    return (
        posts.join(keys, "key")
        .filter(f"members > bit_count(sizes) OR (sizes & ({near})) != 0")
        .select("key", "id", "size", "members")
    )


def prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, id, size): each node (id, n, sign) under its rarest shared coordinate values."""
    posts = nodes.select(
        "id", size_class(percent).alias("size"), F.posexplode("sign").alias("at", "value")
    ).select("id", "size", (F.col("at").cast("long") * (1 << 32) + F.col("value")).alias("key"))
    rarest = F.slice("posts", F.lit(1), F.size("posts") - AGREE + 1).key
    return (
        met(posts)
        .groupBy("id", "size")
        .agg(F.sort_array(F.collect_list(F.struct("members", "key"))).alias("posts"))
        .filter(F.size("posts") >= AGREE)
        .select("id", "size", F.explode(rarest).alias("key"))
        .select("key", "id", "size")
    )


def may_agree(left: str, right: str, share: float):
    """Sizes and leading bits allow the similarity."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    each = [
        F.bit_count(F.col(f"{left}.{w}").bitwiseXOR(F.col(f"{right}.{w}"))) for w in CARRIED[1:]
    ]
    differ = reduce(lambda x, y: x + y, each)
    return (F.least(n, m) >= share * F.greatest(n, m)) & (differ <= 64 * LEADING - LEADING_AGREE)


def all_agree(left: str, right: str):
    """The whole sketches agree in ``BITS_AGREE`` bits or more."""
    each = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda total, one: total + one) <= 64 * WORDS - BITS_AGREE


def agreeing(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs whose whole sketches agree."""
    return (
        pairs.join(sketched.select(F.col("id").alias("a"), F.col("words").alias("words_a")), "a")
        .join(sketched.select(F.col("id").alias("b"), F.col("words").alias("words_b")), "b")
        .filter(all_agree("words_a", "words_b"))
        .select("a", "b")
    )


def pair_up(a: str, b: str):
    return [
        F.least(F.col(f"{a}.id"), F.col(f"{b}.id")).alias("a"),
        F.greatest(F.col(f"{a}.id"), F.col(f"{b}.id")).alias("b"),
    ]


def star_pairs(posts: DataFrame, turn: int, share: float) -> DataFrame:
    """Each member of a posting with the posting's pivot, where their components differ."""
    row = F.struct(
        (F.col("id") if turn == 0 else F.xxhash64("id", "key", F.lit(turn))).alias("order"),
        "id",
        "comp",
        *CARRIED,
    )
    pivots = (
        posts.groupBy("key")
        .agg(F.min(row).alias("pivot"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low < high")
        .select("key", "pivot")
    )
    met = posts.select("key", F.struct("id", "comp", *CARRIED).alias("one")).join(pivots, "key")
    return (
        met.filter(F.col("one.comp") != F.col("pivot.comp"))
        .filter(may_agree("one", "pivot", share))
        .select(*pair_up("one", "pivot"))
        .distinct()
    )


def strays(posts: DataFrame) -> DataFrame:
    """Members outside their posting's largest component, with that and the posting's size."""
    sizes = posts.groupBy("key", "comp").agg(F.count("*").alias("size"))
    main = (
        sizes.groupBy("key")
        .agg(
            F.max_by("comp", F.struct("size", "comp")).alias("main"),
            F.sum("size").alias("total"),
            F.count("*").alias("parts"),
        )
        .filter("parts > 1")
    )
    return posts.join(main, "key").filter(F.col("comp") != F.col("main"))


def stray_pairs(posts: DataFrame, out: DataFrame, sketched: DataFrame, share: float) -> DataFrame:
    """All agreeing pairs across components within a posting, each once.

    Members without any partner by their leading bits go first; the others take their whole
    sketches along, so that a pair is only made if it agrees.
    """

    def met(one: DataFrame, two: DataFrame):
        """Condition of members of one posting that are apart and may agree."""
        apart = (F.col("one.key") == F.col("two.key")) & (F.col("one.comp") != F.col("two.comp"))
        return one.alias("one"), two.alias("two"), apart & may_agree("one", "two", share)

    one, two, condition = met(out.select("key", "main", "id", "comp", *CARRIED), posts)
    live = tables.written(one.join(two, condition, "left_semi"), "live")
    one, two, condition = met(posts, live)
    mates = tables.written(one.join(two, condition, "left_semi"), "mates")
    ids = live.select("id").union(mates.select("id")).distinct()
    whole = tables.written(
        posts.join(ids, "id", "left_semi")
        .groupBy("id")
        .agg(F.array_sort(F.collect_set("key")).alias("keys"))
        .join(sketched.select("id", "words"), "id"),
        "whole",
    )
    one, two, condition = met(live.join(whole, "id"), mates.join(whole, "id"))
    once = (F.col("two.comp") == F.col("one.main")) | (F.col("one.id") < F.col("two.id"))
    first = F.array_min(F.array_intersect("one.keys", "two.keys")) == F.col("one.key")
    return (
        one.join(two, condition & once & all_agree("one.words", "two.words") & first)
        .select(*pair_up("one", "two"))
        .distinct()
    )


def hung(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after each component took the smallest one it is linked to, and that one's."""
    ends = across(labels, links)
    low = (
        ends.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("down"))
        .groupBy("id")
        .agg(F.min("down").alias("down"))
    )
    low = tables.written(low, "steps")
    next_low = low.select(F.col("id").alias("down"), F.col("down").alias("deeper"))
    steps = low.join(next_low, "down", "left").select(
        F.col("id").alias("comp"), F.coalesce("deeper", "down").alias("to")
    )
    return tables.written(
        labels.join(steps, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")),
        "labels",
    )


def across(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Links as pairs of different components."""
    return (
        links.join(labels.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a")
        .join(labels.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b")
        .filter(F.col("x") != F.col("y"))
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union.

    Each pair's first text heads a chunk of its partners; a popular head is copied to at most
    ``SPREAD`` chunks, so its partners are compared by many tasks, one text at a time.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for batch in batches:
            left, right = [], []
            rows = zip(
                batch.column("a").to_pylist(),
                batch.column("chunk").to_pylist(),
                batch.column("role").to_pylist(),
                batch.column("id").to_pylist(),
                words.shingle_sets(batch.column("text"), width),
                strict=True,
            )
            for a, chunk, role, own, found in rows:
                if (a, chunk) != at:
                    at, heads = (a, chunk), []
                if role == 0:
                    heads.append(found)
                    continue
                for head in heads:
                    both = len(np.intersect1d(head, found, assume_unique=True))
                    if 100 * both >= percent * (len(head) + len(found) - both):
                        left.append(a)
                        right.append(own)
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    chunked = pairs.select(
        "a", "b", F.pmod(F.xxhash64("b"), F.lit(SPREAD)).cast("int").alias("chunk")
    )
    heads = (
        chunked.select("a", "chunk")
        .distinct()
        .join(texts, F.col("a") == F.col("id"))
        .select("a", "chunk", F.lit(0).alias("role"), "id", "text")
    )
    tails = chunked.join(texts, F.col("b") == F.col("id")).select(
        "a", "chunk", F.lit(1).alias("role"), "id", "text"
    )
    return (
        heads.union(tails)
        .repartition("a", "chunk")
        .sortWithinPartitions("a", "chunk", "role")
        .mapInArrow(compare, "a long, b long")
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    component_id is the smallest id reachable over links; kept marks that one document.
    """
    share = percent / 100
    rows = tables.written(sketches(docs, width), "sketches")
    nodes = tables.written(
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            F.first("sign").alias("sign"),
        ),
        "nodes",
    )
    posts = tables.written(prefixes(nodes.select("id", "n", "sign"), percent), "prefixes")
    posts = tables.written(met(posts).select("key", "id").distinct(), "postings")
    active = posts.select("id").distinct()
    texts = tables.written(
        docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
        .join(active.hint("shuffle_hash"), "id", "left_semi"),
        "active",
    )
    sketched = tables.written(
        bit_words(texts, width).distinct(), "sketched"
    )
    posts = tables.written(posts.join(sketched.select("id", *CARRIED), "id"), "postings")
    labels = sketched.select("id", F.col("id").alias("comp")).distinct()
    links, turn = None, 0
    while True:
        if turn == 0:
            now = posts.withColumn("comp", F.col("id"))
        else:
            now = tables.written(posts.join(labels, "id"), "members")
        out = tables.written(strays(now), "strays") if turn else None
        total = out.agg(F.sum("total").alias("pairs")).first().pairs or 0 if turn else 0
        last = turn > 0 and (turn >= MOST_STARS or total <= PAIRS_PER_POSTING * posts.count())
        if not last:
            pairs = agreeing(star_pairs(now, turn, share), sketched)
        elif total:
            pairs = stray_pairs(now, out, sketched, share)
        else:
            break
        new = tables.written(
            verified(tables.written(pairs, "pairs"), texts, width, percent), "links"
        )
        links = new if links is None else links.union(new)
        if last:
            break
        labels = hung(labels, new)
        turn += 1
    merged = tables.written(across(labels, links).distinct(), "merged")
    if not merged.isEmpty():
        tops = labels.select(F.col("comp").alias("id")).distinct()
        joined = tables.components(merged, tops.select("id", F.col("id").alias("comp")))
        labels = tables.written(
            labels.select("id", F.col("comp").alias("at"))
            .join(joined.select(F.col("id").alias("at"), "comp"), "at")
            .select("id", "comp"),
            "labels",
        )
    by_set = nodes.select("set_key", "id").join(labels, "id", "left")
    found = by_set.select("set_key", F.coalesce("comp", "id").alias("comp"))
    linked = F.col("n_shingles") > 0
    component = F.when(
        F.col("doc_id").isNotNull(), F.when(linked, F.col("comp")).otherwise(F.col("doc_id"))
    )
    return rows.join(found, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
