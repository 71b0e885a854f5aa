"""Weighted MinHash by consistent weighted sampling.

Repeating a shingle's hash by its weight cannot change a minimum. Here the weights do
change the sample (Ioffe 2010): with r and c from Gamma(2, 1) and b uniform, all fixed by
the shingle and the hash function, a shingle of weight w has t = floor(ln w / r + b),
ln y = r (t - b), and the shingle with the least ln c - ln y - r is the sample, together
with its t. Two documents have equal samples with the probability of their weighted
Jaccard similarity: the sum of the smaller weights over that of the larger ones.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import PRIME
from loomwork.operators.similarity import set_representation
from loomwork.operators.skew import SALT_ROWS, attach

#: Uniform numbers of a hash function, each from three bytes of a shingle's md5.
UNIFORMS = 5
# Rows that are drawn for at a time, so that their numbers stay in a core's cache.
KERNEL_ROWS = 1 << 13


def sampling_parameters(num_hashes: int, seed: int) -> list[list[tuple[int, int]]]:
    """Five maps x -> (a x + b) mod 2^31-1 per hash function, a not 0."""
    draw = random.Random(seed)
    return [
        [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(UNIFORMS)] for _ in range(num_hashes)
    ]


def weighted_shingles(
    shingled: DataFrame, weights: DataFrame, salt_rows: int = SALT_ROWS, cells: DataFrame | None = None
) -> DataFrame:
    """``doc_id, shingle, weight`` of each shingle with a weight over 0.

    ``weights`` has ``shingle``, ``df`` (how many documents hold it) and ``idf``. If they come
    from ``similarity.dealt_cells``, these are given as ``cells`` and meet them where they are.
    """
    if cells is not None:
        joined = cells.join(weights.hint("merge"), "shingle")
    else:
        held = set_representation(shingled).select("doc_id", "shingle")
        joined = attach(held, weights, ["shingle"], ["doc_id"], rows="df", salt_rows=salt_rows)
    return joined.where("idf > 0").select("doc_id", "shingle", F.col("idf").alias("weight"))


def weighted_minhash(weighted: DataFrame, num_hashes: int = 100, seed: int = 42) -> DataFrame:
    """``doc_id, samples``: per hash function the sampled shingle and its t.

    ``weighted`` has ``doc_id``, ``shingle`` and ``weight``, over 0, each shingle once a
    document. Documents without such a shingle have no row.

    Rows pass sorted by document, and a document is done when the next one begins, so
    nothing holds a document's shingles together.
    """
    maps = np.array(sampling_parameters(num_hashes, seed), dtype=np.uint64)

    def sampled(batches):
        kept, kept_score, kept_words, kept_t = None, None, None, None

        def rows(ids, words, t):
            structs = pa.StructArray.from_arrays([pa.array(words.ravel(), pa.string()), pa.array(t.ravel())], ["shingle", "t"])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * num_hashes, pa.int32()), structs)
            return pa.RecordBatch.from_arrays([ids, lists], ["doc_id", "samples"])

        for whole in batches:
            for at in range(0, whole.num_rows, KERNEL_ROWS):
                batch = whole.slice(at, KERNEL_ROWS)
                ids, held = batch.column(0), batch.column(1)
                ends = pc.run_end_encode(ids).run_ends.to_numpy()
                heads = np.append(0, ends[:-1])
                size = np.diff(np.append(0, ends))
                digits = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, 16).astype(np.uint64)
                # a digest's first 15 bytes are five numbers of three
                x = [digits[:, 3 * j] << 16 | digits[:, 3 * j + 1] << 8 | digits[:, 3 * j + 2] for j in range(UNIFORMS)]
                log_w = np.log(batch.column(2).to_numpy())

                def uniform(own, j, numbers):
                    # modulo 2^31-1 by adding the upper bits to the lower ones; below 0 wraps round
                    value = own[j, 0] * numbers + own[j, 1]
                    value = (value & PRIME) + (value >> 31)
                    return (np.minimum(value, value - PRIME).astype(np.int64) + 0.5) / PRIME

                score = np.empty((len(heads), num_hashes))
                place, t = np.empty((2, len(heads), num_hashes), dtype=np.int64)
                for k, own in enumerate(maps):
                    r = -np.log(uniform(own, 0, x[0]) * uniform(own, 1, x[1]))
                    log_c = np.log(-np.log(uniform(own, 2, x[2]) * uniform(own, 3, x[3])))
                    # r (t - b) lies between ln w - r and ln w: few can be the least of their document
                    most = np.repeat(np.minimum.reduceat(log_c - log_w, heads), size)
                    few = np.flatnonzero(log_c - log_w - r <= most + 1e-6)
                    b = uniform(own, 4, x[4][few])
                    steps = np.floor(log_w[few] / r[few] + b)
                    scores = log_c[few] - r[few] * (steps - b) - r[few]
                    starts = np.searchsorted(few, heads)
                    score[:, k] = np.minimum.reduceat(scores, starts)
                    least = np.flatnonzero(scores == np.repeat(score[:, k], np.diff(np.append(starts, len(few)))))
                    if len(least) > len(heads):
                        # ties go to the smaller shingle, so that they are the same in every run
                        tied = zip(np.searchsorted(starts, least, "right"), held.take(pa.array(few[least])).to_pylist(), least)
                        least = np.array([i for _, _, i in sorted(tied)])
                        own_head = np.searchsorted(starts, least, "right")
                        best = least[np.searchsorted(own_head, np.arange(1, len(heads) + 1))]
                    else:
                        best = least
                    place[:, k], t[:, k] = few[best], steps[best]
                words = np.array(held.take(pa.array(place.ravel())).to_pylist(), dtype=object).reshape(place.shape)
                if kept is not None and kept.equals(ids.slice(0, 1)):
                    earlier = (kept_score < score[0]) | ((kept_score == score[0]) & (kept_words <= words[0]).astype(bool))
                    words[0], t[0] = np.where(earlier, kept_words, words[0]), np.where(earlier, kept_t, t[0])
                    score[0] = np.where(earlier, kept_score, score[0])
                elif kept is not None:
                    yield rows(kept, kept_words, kept_t)
                if len(heads) > 1:
                    yield rows(ids.take(pa.array(heads[:-1])), words[:-1], t[:-1])
                kept, kept_score, kept_words, kept_t = ids.slice(int(heads[-1]), 1), score[-1], words[-1], t[-1]
        if kept is not None:
            yield rows(kept, kept_words, kept_t)

    dealt = weighted.select("doc_id", "shingle", F.col("weight").cast("double").alias("weight"))
    placed = dealt.repartition("doc_id").sortWithinPartitions("doc_id")
    made = placed.select("*", F.unhex(F.md5(F.col("shingle").cast("binary"))).alias("digest"))
    doc_id = weighted.schema["doc_id"].dataType.simpleString()
    return made.mapInArrow(sampled, f"doc_id {doc_id}, samples array<struct<shingle: string, t: bigint>>")


def sample_similarity(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """``doc_id_1, doc_id_2, similarity``: the share of equal samples of each given pair."""

    def side(number: int) -> DataFrame:
        return samples.select(F.col("doc_id").alias(f"doc_id_{number}"), F.col("samples").alias(f"s{number}"))

    equal = F.size(F.filter(F.zip_with("s1", "s2", lambda a, b: a.eqNullSafe(b)), lambda e: e))
    joined = pairs.select("doc_id_1", "doc_id_2").join(side(1), "doc_id_1").join(side(2), "doc_id_2")
    return joined.select("doc_id_1", "doc_id_2", (equal / F.size("s1")).alias("similarity"))
