"""SimHash near-dedup: fingerprints linked by Golay-code fuzzy hashing.

1. A text's fingerprint has a bit for each bit that is set in over half the hashes of its four-word shingles.
   Only distinct fingerprints go further.
2. A fingerprint is cut into three segments of 22, 21 and 21 bits, each a word of the binary Golay code's 23 bits. The code is
   perfect: any word has one codeword within three errors. A segment's keys are the codewords of itself and of all
   words that differ in one bit: one key if the word is within two errors of a codeword, else six. Segments that differ in two
   bits at most have a word between them, and so a key in common.
3. Near fingerprints share a bucket. Of four differing bits, either no segment has more than two, and they share a key of
   all three segments; or one segment has three or four, and of the others one is equal and the other differs in one bit at
   most: they share the equal segment and a key of the other. A bucket is 34 or 36 bits and hardly ever shared by chance.
4. Buckets are counted, with their least and greatest member. For nearly all shared ones these are both members, and the pair
   is verified by counting bits. Only members of larger buckets are made again: a bitmap of fixed size picks them.
5. Each larger bucket of an equal segment is a star first: its members are checked against its least and greatest one and two
   random ones. The links found so far give components, which hold nearly all of a dense group.
6. Buckets whose members are still in several components are joined: members outside the bucket's largest component meet all
   members. Pairs of other components are verified. Links between components are what is kept.
7. Components of both kinds of links give every row its smallest document.

No pairs within a group of copies are made: copies are one fingerprint, a dense group is connected by stars, and hot buckets
are split by adaptive joins.

Defined cases: a null text or one without words has fingerprint zero and is linked like others; fewer than four words are one
shingle; repeated rows share a component; a null doc_id takes part and gives a null component where no other id is in it; very long
texts are hashed in slices; an empty table gives an empty result; columns beside id and text are not read.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.components import components, refined
from caudal.llm.shared import bitmap_of, in_batches, in_bitmap, keyed_join, release, scope, staged

SHINGLE = 4
SEED = 42
DIFFERENT = 4
SEGMENTS = (22, 21, 21)
SLICE = 1 << 15
# The generator polynomial of the binary Golay code of 23 bits, a fixed value of the code.
GENERATOR = 0b110001110101
CODE_BITS, DATA_BITS = 23, 12
CHECK_BITS = CODE_BITS - DATA_BITS
MOST_KEYS = 6


def shingle_hashes(text: str | None, size: int = SHINGLE, at_once: int = SLICE):
    """Arrays of the hashes of the shingles of a text, repeats included; none without words."""
    words = (text or "").encode().lower().split()  # A-Z only; the six white-space characters of ASCII
    if not words:
        return
    whole = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(starts), at_once):
        part = zip(starts[at:at + at_once], ends[at:at + at_once], strict=True)
        yield np.array([hashed(whole[a:b], SEED) for a, b in part], np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64 bits: those that are set in over half the hashes."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed integer, of each row."""
    def each(columns):
        prints = np.array([fingerprint(text, size) for text in columns["text"]], np.uint64)
        yield {"doc_id": columns["doc_id"], "fp": prints.view(np.int64)}

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), each, "doc_id long, fp long")


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of words of 23 bits by the generator."""
    words = words.copy()
    for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - CHECK_BITS), 0)
    return words


@lru_cache(maxsize=1)
def corrections() -> np.ndarray:
    """For each syndrome the error of at most three bits that has it."""
    out = np.zeros(1 << CHECK_BITS, np.int64)
    for errors in range(1, 4):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(CODE_BITS), errors)])
        out[syndromes(patterns)] = patterns
    return out


def segment_keys(words: np.ndarray, width: int) -> np.ndarray:
    """The data bits of the codewords of each word and of its neighbours in `width` bits, distinct, padded with -1."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    checks = syndromes(words)[:, None] ^ syndromes(flips)[None, :]
    found = np.sort(((words[:, None] ^ flips[None, :]) ^ corrections()[checks]) >> CHECK_BITS, axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    out = np.full((len(words), MOST_KEYS), -1)
    rows, _ = np.nonzero(new)
    out[rows, (np.cumsum(new, axis=1) - 1)[new]] = found[new]
    return out


def buckets_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of a fingerprint, bucket) of all buckets of each fingerprint."""
    words, keys, at = [], [], 0
    for width in SEGMENTS:
        words.append((prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
        keys.append(segment_keys(words[-1], width))
        at += width
    one, two, three = keys
    families = [((one[:, :, None, None] << DATA_BITS | two[:, None, :, None]) << DATA_BITS | three[:, None, None, :],
                 (one >= 0)[:, :, None, None] & (two >= 0)[:, None, :, None] & (three >= 0)[:, None, None, :])]
    for a, b in permutations(range(len(SEGMENTS)), 2):
        families.append((words[a][:, None] << DATA_BITS | keys[b], keys[b] >= 0))
    places, found = [], []
    for number, (buckets, there) in enumerate(families):
        places.append(np.nonzero(there)[0])
        found.append(buckets[there] | number << 3 * DATA_BITS)
    return np.concatenate(places), np.concatenate(found)


def bucketed(prints: DataFrame, wanted=None) -> DataFrame:
    """fp and bucket of each distinct fingerprint, some 200 rows each; `wanted` is a broadcast bitmap of buckets to keep."""
    def each(columns):
        values = np.array(columns["fp"], np.int64)
        for at in range(0, len(values), 1000):
            part = values[at:at + 1000]
            places, buckets = buckets_of(part.view(np.uint64))
            if wanted is not None:
                keep = in_bitmap(wanted.value, buckets)
                places, buckets = places[keep], buckets[keep]
            yield {"fp": part[places], "bucket": buckets}

    return in_batches(prints, each, "fp long, bucket long", "fp")


def near(a: str, b: str, most: int = DIFFERENT) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= most


def _link(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def star_links(entries: DataFrame, most: int) -> DataFrame:
    """Links (a, b) of the members of each bucket to four of its members."""
    order = F.xxhash64("fp", "bucket")
    centres = entries.groupBy("bucket").agg(
        F.min("fp").alias("c0"), F.max("fp").alias("c1"),
        F.min(F.struct(order, "fp"))["fp"].alias("c2"), F.max(F.struct(order, "fp"))["fp"].alias("c3"))
    rows = keyed_join(entries, centres, ["bucket"])
    links = F.array(*(F.when((F.col("fp") != F.col(c)) & near("fp", c, most), F.col(c)) for c in ("c0", "c1", "c2", "c3")))
    return (rows.select("fp", F.explode(F.array_distinct(F.array_compact(links))).alias("to"))
            .select(*_link("fp", "to")).distinct())


def crossing_links(entries: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Links (a, b) between components, of near fingerprints in a bucket."""
    with scope() as work:
        named = staged(entries.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "zstd")
        sizes = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        largest = (sizes.groupBy("bucket").agg(F.max(F.struct("n", "label"))["label"].alias("main"),
                                               F.count(F.lit(1)).alias("labels")).filter("labels > 1"))
        several = staged(keyed_join(named, largest.drop("labels"), ["bucket"]), "zstd")
        work.drop(named)
        release(entries.sparkSession)
        other = several.select("bucket", F.col("fp").alias("fp2"), F.col("label").alias("label2"))
        pairs = several.filter("label != main").join(other, "bucket").filter(
            (F.col("label") != F.col("label2")) & near("fp", "fp2", most))
        return work.result(pairs.select(*_link("label", "label2")).distinct())


def linked_prints(prints: DataFrame, most: int = DIFFERENT) -> DataFrame:
    """fp, label: the component of each distinct fingerprint that has a near one."""
    with scope() as work:
        shared = staged(bucketed(prints).groupBy("bucket").agg(
            F.count(F.lit(1)).alias("members"), F.min("fp").alias("c0"), F.max("fp").alias("c1"))
            .filter("members > 1"), "zstd")
        release(prints.sparkSession)
        pairs = shared.filter(near("c0", "c1", most)).select(*_link("c0", "c1"))
        larger = shared.filter("members > 2").select("bucket")
        wanted = prints.sparkSession.sparkContext.broadcast(bitmap_of(larger, "bucket"))
        entries = staged(bucketed(prints, wanted).join(larger, "bucket", "left_semi"), "zstd")
        equal_segment = entries.filter(F.col("bucket") >= 1 << 3 * DATA_BITS)
        first = components(pairs.unionByName(star_links(equal_segment, most)))
        release(prints.sparkSession)
        labels = first.select(F.col("id").alias("fp"), F.col("component").alias("label"))
        joined = refined(first, crossing_links(entries, labels, most))
        return work.result(joined.select(F.col("id").alias("fp"), F.col("component").alias("label")))


def simhash_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = DIFFERENT) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, fingerprint, component_id."""
    if not 0 <= most <= DIFFERENT:
        raise ValueError(f"the segments cover {DIFFERENT} differing bits at most")
    with scope() as work:
        rows = staged(fingerprints(docs, size))
        least = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
        labels = linked_prints(least.select("fp"), most)
        named = least.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
        named = staged(named)
        lowest = named.groupBy("label").agg(F.min("least").alias("component_id"))
        found = keyed_join(named.select("fp", "label"), lowest, ["label"]).select("fp", "component_id")
        hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
        return work.result(keyed_join(rows, found, ["fp"]).select(
            "doc_id", hexed.alias("fingerprint"), "component_id"))
