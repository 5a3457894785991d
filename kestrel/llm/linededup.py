"""Operator 4: line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased, split at white space).  Lines
with equal sets are one class; a class's first occurrence in (doc_id, line)
order stays and the others go.  A first occurrence also goes when an earlier
line, kept or not, has a Jaccard similarity of at least the threshold with it.

The join orders each line's words by rarity over the corpus and indexes only the
prefix that two similar lines must share.  Pairs within a word's postings pass
the length, positional and bitmap filters, none of which loses a similar pair;
those left link lines into clusters, and inside a cluster full sets decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.clusters import block_pairs, by_cluster, matched, member_bits, only_members
from kestrel.llm.components import connected_components
from kestrel.llm.store import Scratch, columns
from kestrel.llm.text import fmix, hashes, pieces, spans, utf8
from kestrel.plans.topk import top_k

THRESHOLD = 90           # percent
RARITY_SLOTS = 1 << 17   # counters of the rarity table; its size does not grow with the data
GROUP_POSTINGS = 100_000  # postings of one task of the join
HOT_POSTINGS = 20_000    # a word with more postings is dealt to blocks
_PAIRS = 1 << 19          # pairs looked at together
NO_DOC = 2**63 - 1       # a null doc_id comes last

LINE = ("class bigint, c2 bigint, doc_id bigint, th bigint, line int, size int, s0 bigint, s1 bigint, prefix array<bigint>")


def line_sets(column) -> dict[str, np.ndarray]:
    """Distinct words of every line with a word: per line ``doc`` (row), ``line`` (number) and
    ``start`` (into ``token``), with ``token`` sorted by line and hash."""
    data, offsets = utf8(column)
    starts, ends = spans(data, offsets)
    token = hashes(data, starts, ends)
    breaks = np.flatnonzero(data == 10)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    # Empty texts share an offset with the next one; the last such row owns the word.
    line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[doc])
    new = np.ones(len(token), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    # Words stand in line order already: one number holds the line and most of the word's hash.
    at = np.cumsum(new) - 1
    order = _sorted(at, token, np.argsort((at.astype(np.uint64) << np.uint64(40)) | (token >> np.uint64(24))))
    token, at = token[order], at[order]
    doc, line = doc[new], line[new]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (at[1:] != at[:-1])
    token, at = token[keep], at[keep]
    start = np.searchsorted(at, np.arange(len(doc)))
    return {"token": token, "start": start, "doc": doc, "line": line}


def _sorted(group: np.ndarray, token: np.ndarray, order: np.ndarray) -> np.ndarray:
    """``order`` by (group, leading bits of the token), mended to (group, token) should two tokens of
    a group agree in those bits."""
    g, t = group[order], token[order]
    if ((g[1:] == g[:-1]) & (t[1:] < t[:-1])).any():
        return np.lexsort((token, group))
    return order


def _rarest_first(owner: np.ndarray, rank: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Order by (owner, rank, token); one number holds all but the token's last bits."""
    packed = (owner.astype(np.uint64) << np.uint64(41)) | (rank.astype(np.uint64) << np.uint64(24)) | (token >> np.uint64(40))
    order = np.argsort(packed)
    ranked, t = packed[order], token[order]
    if len(owner) and (owner[-1] >= 1 << 23 or ((ranked[1:] == ranked[:-1]) & (t[1:] < t[:-1])).any()):
        return np.lexsort((token, rank, owner))
    return order


def prefix_size(size, percent: int):
    """Words of a line of ``size`` distinct words that a similar line must share one of."""
    return size - (percent * size + 99) // 100 + 1


def rarity(docs: DataFrame, slots: int = RARITY_SLOTS) -> np.ndarray:
    """Occurrences of words over all documents, counted in ``slots`` hash slots.

    The order built on it only needs to be one and the same everywhere, so words
    that share a slot cost speed, not results.  Every task sends at most ``slots``
    rows, and the driver gets ``slots`` counters whatever the size of the corpus."""
    def run(batches):
        total = np.zeros(slots, np.int64)
        for batch in batches:
            data, offsets = utf8(batch["text"])
            starts, ends = spans(data, offsets)
            total += np.bincount((hashes(data, starts, ends) % np.uint64(slots)).astype(np.int64), minlength=slots)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    counts = docs.select("text").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(slots, np.int64)
    out[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    return out


def lines(docs: DataFrame, table: np.ndarray, percent: int) -> DataFrame:
    """``docs(doc_id, th, text)`` -> one row per line with a word (see LINE)."""
    # Places in the order of rarity, one per slot: 17 bits, where counts may need 64.
    place = np.empty(len(table), np.int64)
    place[np.argsort(table, kind="stable")] = np.arange(len(table))
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches):
        freq = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                s = line_sets(part["text"])
                token, start = s["token"], s["start"]
                if not len(start):
                    continue
                size = np.diff(np.append(start, len(token)))
                owner = np.repeat(np.arange(len(start)), size)
                bit = (token >> np.uint64(57)).astype(np.int64)
                mark = np.uint64(1) << (bit & 63).astype(np.uint64)
                sketch = [np.bitwise_xor.reduceat(np.where(bit >> 6 == k, mark, np.uint64(0)), start) for k in (0, 1)]
                key = fmix(np.add.reduceat(fmix(token ^ np.uint64(0xA5A5A5A5A5A5A5A5)), start)
                           + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                c2 = fmix(np.add.reduceat(fmix(token + np.uint64(0xC2B2AE3D27D4EB4F)), start))
                order = _rarest_first(owner, freq[(token % np.uint64(len(freq))).astype(np.int64)], token)
                position = np.arange(len(token)) - np.repeat(start, size)
                head = prefix_size(size, percent)
                prefix = token[order][position < np.repeat(head, size)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(head)).astype(np.int32)),
                                                 pa.array(prefix.view(np.int64)))
                doc = pa.array(s["doc"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(c2.view(np.int64)), part["doc_id"].take(doc), part["th"].take(doc),
                     pa.array(s["line"].astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array(sketch[0].view(np.int64)), pa.array(sketch[1].view(np.int64)), lists],
                    names=["class", "c2", "doc_id", "th", "line", "size", "s0", "s1", "prefix"])
    return docs.mapInArrow(run, LINE)


def _bits(x: np.ndarray) -> np.ndarray:
    # Of a signed number NumPy counts the bits of its absolute value.
    return np.bitwise_count(x.view(np.uint64))


def join_postings(table: pa.Table, percent: int, split: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one task that link every pair of lines passing all filters.

    Rows are sorted by word and size, so the shorter partners of a line that the
    length filter admits are a run of rows before it; runs are cut into pieces of
    bounded size.  Only pairs of lines not linked yet are returned, so the output
    is smaller than the input however many pairs pass."""
    token, size = table["token"].to_numpy(), table["size"].to_numpy().astype(np.int64)
    position = table["pos"].to_numpy().astype(np.int64)
    s0, s1 = table["s0"].to_numpy(), table["s1"].to_numpy()
    block = table["block"].to_numpy() if split else None
    order = np.lexsort((size, token))
    token, size, position, s0, s1 = (x[order] for x in (token, size, position, s0, s1))
    _, line = np.unique(table["class"].to_numpy()[order], return_inverse=True)
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    word = np.cumsum(new) - 1
    key = word * (1 << 40) + size
    first = np.searchsorted(key, word * (1 << 40) + (percent * size + 99) // 100)
    run = np.arange(len(token)) - first
    label = np.arange(line.max() + 1 if len(line) else 0)

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    out = []
    x = 0
    ends = np.cumsum(run)
    while x < len(token):
        # Rows x..y-1 whose runs together hold about _PAIRS pairs; a longer single run is cut below.
        y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + _PAIRS, side="right")))
        for lo in range(0, int(run[x]) if y == x + 1 else 1, _PAIRS):
            n = np.minimum(run[x:y] - lo, _PAIRS) if y == x + 1 else run[x:y]
            a = np.repeat(np.arange(x, y), n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[x:y] + lo, n)
            total = size[a] + size[b]
            # Jaccard >= percent / 100 means at least `need` words in common.
            need = -(-percent * total // (100 + percent))
            ok = np.minimum(size[a] - position[a], size[b] - position[b]) >= need
            ok &= line[a] != line[b]
            if split:
                ok &= block[order[a]] != block[order[b]]
            a, b, need, total = a[ok], b[ok], need[ok], total[ok]
            # Words in only one of the two flip a bit of the sketch, at most one bit each.
            ok = _bits(s0[a] ^ s0[b]).astype(np.int64) + _bits(s1[a] ^ s1[b]) <= total - 2 * need
            a, b = a[ok], b[ok]
            for i, j in np.unique(np.stack([line[a], line[b]], axis=1), axis=0) if len(a) else ():
                p, q = root(i), root(j)
                if p != q:
                    label[max(p, q)] = min(p, q)
                    out.append((i, j))
        x = y
    names = np.unique(table["class"].to_numpy())
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return names[pairs[:, 0]] if len(pairs) else names[:0], names[pairs[:, 1]] if len(pairs) else names[:0]


def candidate_links(firsts: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links (a, b) between classes that pass the filters."""
    postings = firsts.select("class", "size", "s0", "s1", F.posexplode("prefix").alias("pos", "token"))
    n = firsts.agg(F.sum(F.size("prefix")).alias("n")).first()["n"] or 0
    groups = max(1, -(-n // GROUP_POSTINGS))
    hot = scratch.write(postings.groupBy("token").count().where(F.col("count") > HOT_POSTINGS)
                        .select("token", F.ceil(F.col("count") / HOT_POSTINGS).cast("int").alias("blocks")))

    def run(split):
        def pairs(table: pa.Table) -> pa.Table:
            a, b = join_postings(table, percent, split)
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        return pairs

    tagged = postings.join(hot, "token", "left")
    plain = (tagged.where("blocks is null").drop("blocks")
             .withColumn("group", F.pmod(F.xxhash64("token"), F.lit(groups)))
             .groupBy("group").applyInArrow(run(False), "a bigint, b bigint"))
    # A hot word's postings are dealt to blocks; tasks (i, j) compare block i with block j,
    # and (i, i) stays within one.
    dealt = (tagged.where("blocks is not null")
             .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "_o")).withColumn("j", F.greatest("block", "_o")))
    within = dealt.where("i = j").groupBy("token", "i").applyInArrow(run(False), "a bigint, b bigint")
    across = dealt.where("i < j").groupBy("token", "i", "j").applyInArrow(run(True), "a bigint, b bigint")
    return plain.unionAll(within).unionAll(across)


def matched_classes(docs: DataFrame, firsts: DataFrame, clusters: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Classes whose first line is similar to an earlier one, decided on full sets."""
    members = scratch.write(firsts.join(clusters, F.col("class") == F.col("node"))
                            .select("cluster", "class", "c2", "doc_id", "th", "line", "size"))
    wanted = (members.groupBy("doc_id", "th").agg(F.collect_list(F.struct("line", "class", "c2", "cluster")).alias("wanted"))
              .withColumnsRenamed({"doc_id": "_d", "th": "_t"}))
    texts = only_members(docs, member_bits(members)).join(
        wanted, (F.col("doc_id") == F.col("_d")) & (F.col("th") == F.col("_t"))).select("doc_id", "th", "text", "wanted")

    def sets(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                s = line_sets(part["text"])
                end = np.append(s["start"][1:], len(s["token"]))
                where = {(d, n): i for i, (d, n) in enumerate(zip(s["doc"].tolist(), s["line"].tolist()))}
                ids, th = part["doc_id"].to_pylist(), part["th"].to_pylist()
                rows = [(w["cluster"], w["class"], w["c2"], ids[d], th[d], w["line"],
                         s["token"][s["start"][i]:end[i]].tobytes())
                        for d, some in enumerate(part["wanted"].to_pylist()) for w in some
                        for i in (where[(d, w["line"])],)]
                cols = list(zip(*rows)) if rows else [[]] * 7
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["cluster", "node", "c2", "doc_id", "th", "line", "set"])

    def decide(table: pa.Table) -> pa.Table:
        some = [t.filter(pa.array(matched(t, percent, ["doc_id", "th", "line"]))) for t in by_cluster(table)]
        return pa.concat_tables(some).select(["node", "c2"]).rename_columns(["class", "c2"])

    # Repeated rows of a document bring the same line several times: once is enough.
    shipped = (texts.mapInArrow(sets, "cluster bigint, node bigint, c2 bigint, doc_id bigint, th bigint, line int, set binary")
               .dropDuplicates(["node", "c2"]))
    sizes = members.groupBy("cluster").agg(F.sum("size").alias("tokens"))
    return (block_pairs(shipped, sizes).groupBy("task")
            .applyInArrow(decide, "class bigint, c2 bigint").distinct())


def line_decisions(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per distinct (doc_id, th) that has lines to remove:
    doc_id, th (hash of the text), removed (sorted line numbers from 0).

    A null doc_id comes last and is shown as the largest bigint here."""
    scratch = Scratch(docs.sparkSession)
    own = docs.select(*columns(docs, "doc_id", "text")).where("text is not null").select(
        F.coalesce("doc_id", F.lit(NO_DOC)).cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    every = scratch.write(lines(own, rarity(own), percent))
    firsts = scratch.write(top_k(every, ["class", "c2"], [F.col("doc_id"), F.col("th"), F.col("line")], 1).drop("rank"))
    links = scratch.write(candidate_links(firsts, scratch, percent))
    clusters = connected_components(links).select("node", F.col("component").alias("cluster"))
    similar = scratch.write(matched_classes(own, firsts, clusters, scratch, percent))
    settled = (firsts.select("class", "c2", F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("line").alias("_l"))
               .join(similar.withColumn("_similar", F.lit(True)), ["class", "c2"], "left"))
    gone = (every.select("class", "c2", "doc_id", "th", "line").join(settled, ["class", "c2"])
            .where("_similar OR doc_id != _d OR th != _t OR line != _l"))
    return gone.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def dedup_lines(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """``docs`` with their removed lines cut out of ``text``, plus ``n_lines`` and ``removed``.

    Lines without a word never go.  Null and empty texts stay as they are (0 and 1
    line).  Rows that repeat a (doc_id, text) are one document and lose the same lines.
    Ties in doc_id are ordered by the text's hash.  Other columns pass through.
    """
    out = _cut(docs, percent)
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "removed")]
    return out.select(*(F.col("_doc").getField(c).alias(c) for c in rest), *(F.col(f"_cut.{c}").alias(c) for c in ("text", "n_lines", "removed")))


def _cut(docs: DataFrame, percent: int) -> DataFrame:
    """(_doc: the row as it is, _cut: text, n_lines, removed); a struct keeps the row's names apart from all others."""
    gone = line_decisions(docs, percent).withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    # The row travels once: the text is inside it, and only its keys stand beside it.
    own = (docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *columns(docs, "doc_id", "text"))
           .select("_doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_DOC)).alias("_key"), F.xxhash64("text").alias("_hash")))
    joined = (own.join(gone, (F.col("_key") == F.col("_d")) & (F.col("_hash") == F.col("_t")), "left")
              .withColumn("text", F.col("_doc").getField("text") if "text" in docs.columns else F.lit(None).cast("string")))
    # Hash-based array_except keeps this linear in the number of lines.
    cut = F.expr("array_join(transform(array_except(sequence(0, size(_lines) - 1), removed), i -> get(_lines, i)), '\\n')")
    joined = joined.withColumn("_lines", F.split("text", "\n", -1))
    return joined.select("_doc", F.struct(
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(cut).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed")).alias("_cut"))


def line_stage(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """The documents without their repeated lines; one that loses all its words goes."""
    lost = F.size("_cut.removed") > 0
    out = _cut(docs, percent).where(~lost | F.col("_cut.text").rlike(r"[^\x20\x09-\x0D]"))
    now = {"text": F.col("_cut.text")}
    if "n_chars" in docs.columns:
        now["n_chars"] = F.when(lost, F.length("_cut.text")).otherwise(F.col("_doc").getField("n_chars")).cast(
            docs.schema["n_chars"].dataType)
    return out.select(*(now.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns))


def line_query(docs: DataFrame) -> DataFrame:
    """Per document: number of lines, of removed lines, their numbers and what is left."""
    own = docs.select(*columns(docs, "doc_id", "text"))
    return dedup_lines(own).select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed",
                                   F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
