"""Ranked lexical search of a stated set of items over all documents, by presence masks.

Documents are indexed in blocks of bounded size: per block and term, the places of its documents and the occurrences there. For each
item, bitmaps say which of its terms a document of the block holds; documents of one mask form a group. A mask's greatest score is
the sum of its terms' greatest contributions in the block. Groups are scored exactly by falling greatest score, until the k-th
best score found so far is above that of every group left: a group that could still tie is scored too. The k best of the blocks
are merged by a rank limit.

Items meet documents block by block: their terms (a few KB an item) are sent to every group of blocks, the index is read once. Only terms
that pass a fixed-size bitmap of the items' terms are indexed (128 KB whatever the items are; more than they hold may pass, never less).

Cases: a null or empty text has no terms, in a document or an item; such an item, and one without a document above score 0, has no rows;
every row of either table counts for itself, also with a null or repeated id; equal scores go by smaller id, null last; a text of
any length is taken whole; an empty table gives no rows; extra columns are not read.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from .common import ascii_lower, stored, tasks

TOP = 20
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A block of documents ends at either bound (one document may pass the second by its own terms).
DOCS_IN_BLOCK, POSTINGS_IN_BLOCK = 8192, 1 << 20
# Blocks that one task searches after another.
BLOCKS_IN_GROUP = 8
# Bits of the filter of item terms.
FILTER_BITS = 1 << 20

# Bytes outside words become spaces, A-Z become a-z; bytes of other scripts are as they are.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text):
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def item_terms(items, item_id, text):
    """(item, item_id, term, times) per row and distinct term; item numbers the rows."""
    rows = stored(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(text).alias("text")), "items")
    return (rows.select("item", "item_id", F.explode(terms("text")).alias("term"))
            .groupBy("item", "item_id", "term").agg(F.count("*").alias("times")))


def term_filter(wanted):
    """Bitmap of crc32 values of the terms, as bytes: at most FILTER_BITS bits reach the driver."""
    slot = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(FILTER_BITS))
    width = 1 << 15
    rows = (wanted.select(F.floor(slot / width).alias("row"), F.pmod(slot, F.lit(width)).alias("bit")).distinct()
            .groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = bytearray(FILTER_BITS // 8)
    for r in rows:
        out[r["row"] * width // 8:(r["row"] + 1) * width // 8] = bytes(r["bits"])
    return bytes(out)


class Block:
    """The index of some documents: ids and lengths in terms, and per term the documents that hold it."""

    def __init__(self):
        self.ids, self.lengths, self.postings, self.size = [], [], {}, 0

    def add(self, doc_id, words, passes):
        place, counts = len(self.ids), {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        for word, n in counts.items():
            if passes(word):
                self.postings.setdefault(word, []).append((place, n))
                self.size += 1

    def full(self):
        return len(self.ids) >= DOCS_IN_BLOCK or self.size >= POSTINGS_IN_BLOCK

    def rows(self, block, id_type, schema):
        """One row for the documents, one for each term. Documents are placed by id, null last, so equal scores go by place."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        lengths = np.array(self.lengths, np.int64)[order]
        words = list(self.postings)
        docs, times = [lengths.tobytes()], [b""]
        for word in words:
            held = np.array(self.postings[word], np.int64)
            at = place[held[:, 0]]
            by = np.argsort(at)
            docs.append(at[by].tobytes())
            times.append(held[by, 1].astype(np.int32).tobytes())
        n = 1 + len(words)
        return pa.RecordBatch.from_arrays([
            pa.array([block] * n, pa.int64()), pa.array([None, *words], pa.binary()),
            pa.array([len(order)] + [len(self.postings[w]) for w in words], pa.int64()), pa.array([int(lengths.sum())] + [None] * len(words), pa.int64()),
            pa.array(docs, pa.binary()), pa.array(times, pa.binary()),
            pa.array([[self.ids[i] for i in order]] + [None] * len(words), pa.list_(id_type))], schema=schema)


def index(docs, doc_id, text, bits):
    """Blocks of documents as rows (block, term, n, total, docs, times, ids); the row without term describes the documents: their number,
    all their terms, lengths and ids. Documents without terms are left out."""
    kind = docs.schema[doc_id].dataType
    id_type = to_arrow_type(kind)
    schema = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("total", pa.int64()), ("docs", pa.binary()), ("times", pa.binary()),
                        ("ids", pa.list_(id_type))])
    crc = zlib.crc32

    def build(batches):
        known = {}

        def passes(word):
            held = known.get(word)
            if held is None:
                if len(known) > 500_000:
                    known.clear()
                slot = crc(word) % FILTER_BITS
                held = known[word] = bool(bits[slot >> 3] >> (slot & 7) & 1)
            return held

        block = Block()
        number = None
        for batch in batches:
            for part, key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if number is None:
                    number = part << 32
                value = value.as_buffer()
                words = value.to_pybytes().translate(_FOLD).split() if value is not None else ()
                if words:
                    block.add(key, words, passes)
                    if block.full():
                        yield block.rows(number, id_type, schema)
                        block, number = Block(), number + 1
        if block.ids:
            yield block.rows(number, id_type, schema)

    slim = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(doc_id), F.col(text).cast("binary").alias("value"))
    return slim.mapInArrow(build, f"block long, term binary, n long, total long, docs binary, times binary, ids array<{kind.simpleString()}>")


class BlockSearch:
    """Scores of one block's documents. An item's weights are whole numbers; so is every score."""

    def __init__(self, lengths, postings, n_docs, n_terms):
        self.norm = 75 + 25 * lengths * n_docs // n_terms
        self.postings, self.ready = postings, {}

    def term(self, term):
        """(places, contributions at weight 1, the greatest of them), or None."""
        held = self.ready.get(term)
        if held is None and term in self.postings:
            docs, times = self.postings[term]
            gain = 1_000_000_000 * times // (1000 * times + 12 * self.norm[docs])
            held = self.ready[term] = docs, gain, int(gain.max())
        return held

    def masks(self, parts):
        """(documents, mask number of each, masks as rows of 0 and 1) for documents that hold any of the parts."""
        words = -(-len(parts) // 64)
        bitmap = np.zeros((len(self.norm), words), np.uint64)
        for i, (_, docs, _, _) in enumerate(parts):
            bitmap[docs, i >> 6] |= np.uint64(1 << (i & 63))
        docs = np.flatnonzero(bitmap.any(1))
        held = np.ascontiguousarray(bitmap[docs])
        keys = held[:, 0] if words == 1 else held.view(np.dtype((np.void, 8 * words)))[:, 0]
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        bits = np.unpackbits(held[first].view(np.uint8), axis=1, bitorder="little")[:, :len(parts)]
        return docs, group, bits

    def best(self, weighted, k, floor=0):
        """(places, scores) of the k best documents with a score above 0 and not under `floor`, ties to the smaller place. weighted: (term,
        weight) of an item."""
        parts = []
        for term, weight in weighted:
            held = self.term(term) if weight > 0 else None
            if held:
                parts.append((weight, *held))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, group, bits = self.masks(parts)
        most = bits.astype(np.int64) @ np.array([w * top for w, _, _, top in parts], np.int64)
        order = np.argsort(-most, kind="stable")
        sizes = np.bincount(group, minlength=len(most))[order]
        members = np.argsort(group, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(group, minlength=len(most)))]
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, want = 0, k
        while at < len(order) and most[order[at]] >= max(floor, 1):
            # The next groups, at least `want` documents of them, none that cannot reach the floor.
            upto = at + 1 + int(np.searchsorted(np.cumsum(sizes[at:]), want))
            upto = min(upto, at + int(np.searchsorted(-most[order[at:]], -max(floor, 1), side="right")))
            here = np.sort(np.concatenate([docs[members[starts[g]:starts[g + 1]]] for g in order[at:upto]]))
            score = np.zeros(len(here), np.int64)
            for weight, held, gain, _ in parts:
                i = np.searchsorted(held, here)
                i[i == len(held)] = 0
                score += np.where(held[i] == here, weight * gain[i], 0)
            places, scores = np.r_[places, here], np.r_[scores, score]
            keep = np.lexsort((places, -scores))[:k]
            places, scores = places[keep], scores[keep]
            if len(scores) == k:
                floor = max(floor, int(scores[-1]))
            at, want = upto, want * 4
        keep = scores >= max(floor, 1)
        return places[keep], scores[keep]


def ranked(docs, items, doc_id="doc_id", text="text", item_id="item_id", item_text="text", k=TOP):
    """(item_id, rank, doc_id, score): the k best documents of every row of items."""
    wanted = stored(item_terms(items, item_id, item_text), "item-terms")
    blocks = stored(index(docs, doc_id, text, term_filter(wanted)), "term-index")
    about = blocks.where("term is null").agg(F.count("*").alias("blocks"), F.sum("n").alias("docs"), F.sum("total").alias("terms"),
                                                F.max(F.shiftright("block", 32)).alias("last")).first()
    id_type = docs.schema[doc_id].dataType.simpleString()
    out = f"item long, doc_id {id_type}, score long"
    n_docs, n_terms = about["docs"] or 0, about["terms"] or 0
    df = blocks.where("term is not null").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighted = (wanted.select("item", "item_id", F.col("term").cast("binary").alias("term"), "times").join(df, "term")
                .groupBy("item", "item_id").agg(F.collect_list(F.struct("term", (F.col("times") * weight).alias("weight"))).alias("terms")))
    weighted = stored(weighted, "weighted-items")
    groups = max(1, min(about["blocks"], max(tasks(docs.sparkSession), about["blocks"] // BLOCKS_IN_GROUP)))
    # The n-th blocks of all parts follow one another, so the groups get even numbers of blocks.
    place = F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1) * ((about["last"] or 0) + 1)
    left = blocks.withColumn("g", F.pmod(place, F.lit(groups)).cast("int"))
    right = weighted.select("item", "terms").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        found = {"item": [], "score": []}
        ids = []
        id_list = held.schema.field("ids").type.value_type
        number = held.column("block").to_numpy()
        queries = [(item, [(t["term"], t["weight"]) for t in ts]) for item, ts in zip(asked.column("item").to_pylist(), asked.column("terms").to_pylist())]
        floors = {item: [] for item, _ in queries}  # scores found so far in this task, the k best
        for block in np.unique(number):
            part = held.filter(pa.array(number == block))
            postings, lengths, names = {}, None, None
            for term, d, t, i in zip(*(part.column(c) for c in ("term", "docs", "times", "ids"))):
                if term.is_valid:
                    postings[term.as_py()] = np.frombuffer(d.as_buffer(), np.int32), np.frombuffer(t.as_buffer(), np.int32).astype(np.int64)
                else:
                    lengths, names = np.frombuffer(d.as_buffer(), np.int64), i.values
            searcher = BlockSearch(lengths, postings, n_docs, n_terms)
            for item, terms_ in queries:
                best = floors[item]
                places, scores = searcher.best(terms_, k, best[k - 1] if len(best) >= k else 0)
                if len(places):
                    floors[item] = sorted(best + scores.tolist(), reverse=True)[:k]
                    found["item"].append(np.full(len(places), item, np.int64))
                    found["score"].append(scores)
                    ids.append(names.take(pa.array(places)))
        joined = {c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in found.items()}
        return pa.table({"item": joined["item"], "doc_id": pa.chunked_array(ids, id_list), "score": joined["score"]})

    hits = left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(search, out)
    by = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return top.join(weighted.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def report(docs, items):
    return ranked(docs, items)
