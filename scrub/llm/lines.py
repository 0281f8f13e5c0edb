"""Near-equal lines by an exact set-similarity join; later ones are removed.

The tokens of a line are its different five-word shingles (or all its words, if it has fewer). Lines of
equal token sets are equal. For others, tokens are put in one order for the whole corpus, rare ones
first. Two sets that are at least as similar as asked must then share a token among the first few of
each (prefix filter); where in the two sets that token stands bounds what can still be common
(positional filter), and so do their sizes (length filter). Candidates are verified on the sets.

Rarity comes from a table of counters of fixed size, in which tokens share counters by hash. It only sets
the order: any order that is the same everywhere gives the same result, a good one fewer candidates.

A line is removed if there is any near-equal line before it, so the sets that share a token are first
compared with the earliest of them; only what that leaves is compared with all earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize, release
from . import kernels as K
from . import repeats

SHINGLE = 5
PERCENT = 80
COUNTERS = 1 << 16
#: (token, name) pairs that a task remembers having sent.
SENT = 1 << 20
#: Places of candidate lines that are broadcast at most (they are counted first).
BROADCAST_ROWS = 500_000
NEWLINE = 10
_U = np.uint64


def _in_order(line: np.ndarray, tokens: np.ndarray, counts: np.ndarray | None) -> np.ndarray:
    """An order by line, then count, then token; without counts by line and token."""
    bits = max(1, int(line[-1]).bit_length()) if len(line) else 1
    low = tokens if counts is None else tokens >> _U(24) | counts << _U(40)
    packed = line.astype(np.uint64) << _U(64 - bits) | low >> _U(bits)
    order = np.argsort(packed)
    packed, sorted_ = packed[order], tokens[order]
    if ((packed[1:] == packed[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
        return np.lexsort([tokens, line] if counts is None else [tokens, counts, line])
    return order


class Lines:
    """The lines of some documents, and the tokens of those with a word, by line and in one order.

    ``counts``: how often the counters have been seen; without, tokens are in the order of their keys.
    """

    def __init__(self, texts: K.Texts, tokens: bool = True, counts: np.ndarray | None = None):
        self.texts = texts
        words = K.words_of(texts)
        breaks = np.flatnonzero(texts.data == NEWLINE)
        # Lines begin at each document and after each line break; an empty document is before the next.
        begin = np.append(texts.offsets[:-1], breaks + 1)
        owner = np.append(np.arange(len(texts)), np.searchsorted(texts.offsets, breaks, "right") - 1)
        order = np.lexsort([begin, owner])
        self.begin, self.document = begin[order], owner[order]
        self.number = np.arange(len(begin)) - np.searchsorted(self.document, self.document)
        self.end = np.append(self.begin[1:], len(texts.data))
        first = np.append(np.searchsorted(words.starts, self.begin), len(words))
        size = np.diff(first)
        self.filled = size > 0
        if not tokens:
            return
        values = K.word_values(texts, words)
        every = K.grams(values, SHINGLE)
        inside = np.flatnonzero(K.within(first, SHINGLE, len(values)))
        line = np.searchsorted(first, inside, "right") - 1
        short = np.flatnonzero((size > 0) & (size < SHINGLE))
        keys = np.append(every[inside], K.stretches(values, first[short], first[short + 1]))
        line = np.append(line, short)
        back = np.argsort(line, kind="stable")
        keys, line = keys[back], line[back]
        order = _in_order(line, keys, None if counts is None else counts[_counter(keys)])
        keys, line = keys[order], line[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (line[1:] != line[:-1])
        self.tokens, self.line = keys[new], line[new]
        self.edges = np.searchsorted(self.line, np.arange(len(self.begin) + 1))
        self.size = np.diff(self.edges)

    def sums(self, values: np.ndarray) -> np.ndarray:
        sums = np.append(_U(0), np.cumsum(values))
        return sums[self.edges[1:]] - sums[self.edges[:-1]]

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two fingerprints of the token set of each line."""
        return K.mix(self.sums(K.mix(self.tokens))), K.mix(self.sums(K.mix(self.tokens ^ _U(K.BASES[0]))))


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (K.mix(tokens) % _U(COUNTERS)).astype(np.int64)


def _listed(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of lists, and the row of each."""
    lists = part.column(part.schema.get_field_index(name))
    rows = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
    return rows, np.asarray(lists.flatten()).astype(np.int64)


class _Sent:
    """Which (token, name) a task has sent already, each with its document; new ones take the places of old ones.

    So a pair that comes in every chunk of text is sent a few times per task.
    """

    def __init__(self):
        self.token, self.name = np.zeros((2, SENT), np.uint64)
        self.id = np.full(SENT, np.iinfo(np.int64).max)

    def fresh(self, token: np.ndarray, name: np.ndarray, id_: np.ndarray) -> np.ndarray:
        """The rows of which no document with a smaller id is known to have been sent."""
        slot = (K.mix(token ^ K.mix(name)) % _U(SENT)).astype(np.int64)
        new = np.flatnonzero((self.token[slot] != token) | (self.name[slot] != name) | (self.id[slot] >= id_))
        slot = slot[new]
        self.token[slot], self.name[slot], self.id[slot] = token[new], name[new], id_[new]
        return new


def _sets(of: list[str]):
    """A function for mapInArrow: (key, whole, document, place) of the first line of each token set.

    At the end (counter, count, NULL ...).
    """
    names = ["key", "whole", *of, "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part, texts in K.chunks(batch):
                lines = Lines(texts)
                counts += np.bincount(_counter(lines.tokens), minlength=COUNTERS)
                one, two = lines.names()
                some = np.flatnonzero(lines.size)
                own = [c[lines.document[some]] for c in repeats.owners(part)]
                kept, _ = repeats.least([one[some], two[some]], own, lines.number[some])
                rows = some[kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[rows].view(np.int64)), pa.array(two[rows].view(np.int64)),
                        *[pa.array(c[kept]) for c in own], pa.array(lines.number[rows].astype(np.int32)),
                    ],
                    names,
                )
        some = np.flatnonzero(counts)
        nothing = [pa.nulls(len(some), pa.int64()) for _ in of]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(counts[some]), *nothing, pa.nulls(len(some), pa.int32())], names
        )

    return run


def _prefixes(table: np.ndarray, percent: int):
    """A function for mapInArrow: (token, name, document, line, n and at in one) of the prefixes of all lines."""
    counts = np.minimum(table, (1 << 23) - 1).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent()
        for batch in batches:
            for part, texts in K.chunks(batch):
                lines = Lines(texts, counts=counts)
                tokens, line = lines.tokens, lines.line
                place = np.arange(len(line)) - lines.edges[line]
                size = lines.size[line]
                kept = np.flatnonzero(place <= size - -(-size * percent // 100))
                one, _ = lines.names()
                token, line, name = tokens[kept], line[kept], one[line[kept]]
                own = [c[lines.document[line]] for c in repeats.owners(part)]
                least, _ = repeats.least([token, name], own, lines.number[line])
                least = least[sent.fresh(token[least], name[least], own[0][least])]
                line = line[least]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token[least].view(np.int64)), pa.array(name[least].view(np.int64)),
                        *[pa.array(c[least]) for c in own], pa.array(lines.number[line].astype(np.int32)),
                        pa.array(lines.size[line] << 32 | place[kept][least]),
                    ],
                    ["token", "name", *repeats.marks(part.schema.names), "line", "shape"],
                )

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, places) to (name, tokens) of the lines at those places."""
    for batch in batches:
        for part, texts in K.chunks(batch):
            every = Lines(texts, tokens=False)
            begin = np.searchsorted(every.document, np.arange(len(texts)))
            rows, places = _listed(part, "places")
            at = np.sort(begin[rows] + places)
            # Each of those lines, without its break, is a text of its own.
            from_, to = every.begin[at], every.end[at]
            to = to - ((to > from_) & (texts.data[to - 1] == NEWLINE))
            size = to - from_
            offsets = np.append(0, np.cumsum(size))
            picked = np.repeat(from_ - offsets[:-1], size) + np.arange(offsets[-1])
            lines = Lines(K.Texts(pa.nulls(len(at)), texts.data[picked], offsets))
            one, _ = lines.names()
            tokens = pa.ListArray.from_arrays(pa.array(lines.edges.astype(np.int32)), pa.array(lines.tokens.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), tokens], ["name", "tokens"])


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in K.unzipped(batch):
            lines = Lines(texts, tokens=False)
            begin = np.searchsorted(lines.document, np.arange(len(texts) + 1))

            def told(name: str) -> np.ndarray:
                on = np.zeros(len(lines.begin), bool)
                rows, places = _listed(part, name)
                at = begin[rows] + places
                on[at[at < begin[rows + 1]]] = True
                return on

            gone = lines.filled & (~told("first") | told("near"))
            removed = np.flatnonzero(gone)
            # A line goes with the break before it; the first that stays loses its break.
            keep = np.repeat(~gone, lines.end - lines.begin)
            kept_bytes = np.flatnonzero(keep)
            edges = np.searchsorted(kept_bytes, texts.offsets)
            cut = np.flatnonzero(gone[begin[1:] - 1] & (edges[1:] > edges[:-1]))
            last = kept_bytes[edges[cut + 1] - 1]
            keep[last[texts.data[last] == NEWLINE]] = False
            offsets = np.append(0, np.cumsum(keep))[texts.offsets]
            by = np.searchsorted(removed, begin).astype(np.int32)
            numbers = pa.ListArray.from_arrays(pa.array(by), pa.array(lines.number[removed].astype(np.int32)))
            has = np.append(0, np.cumsum(lines.filled))
            kept = pa.StringArray.from_buffers(
                len(texts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(texts.data[keep].tobytes())
            )
            rest = [part.column(part.schema.get_field_index("rest"))] if "rest" in part.schema.names else []
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(has[begin])), pa.array(np.diff(by).astype(np.int64)), numbers, kept, *rest],
                ["id", "n_lines", "n_removed", "removed", "kept", *["rest"][:len(rest)]],
            )


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (name, other) whose token sets are at least ``percent`` similar."""
    left = sets.select("name", F.col("tokens").alias("x"))
    right = sets.select(F.col("name").alias("other"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "name").join(right, "other").where(
        both * 100 >= (F.size("x") + F.size("y") - both) * percent
    ).select("name", "other")


def _near(source: DataFrame, counts: np.ndarray, percent: int, unique: bool) -> DataFrame:
    """(document, place) of lines that are the first of their set, but near-equal to an earlier line.

    ``unique``: no two rows have one id, so no row has copies.
    """
    of = repeats.marks(source.columns)
    rows = source.mapInArrow(
        _prefixes(counts, percent), f"token long, name long, {repeats.typed(of)}, line int, shape long"
    )
    # A token that only one set has in its prefix makes no candidate. Tasks send a set once per chunk of
    # text, so the rows of a token are not its lines but its different sets.
    same = Window.partitionBy("token")
    shared = rows.withColumns({"low": F.min("name").over(same), "high": F.max("name").over(same)}).where("low <> high")
    order = F.struct(*of, "line")
    live = materialize(
        shared.groupBy("token", "name").agg(F.min(order).alias("place"), F.min("shape").alias("shape")).select(
            "token", "name", "place", F.shiftright("shape", 32).cast("int").alias("n"), F.col("shape").bitwiseAND((1 << 32) - 1).cast("int").alias("at")
        ), "tokens",
    )
    # The exchange of all prefixes is the largest, and done with.
    release(source.sparkSession)
    places = materialize(live.groupBy("name").agg(F.min("place").alias("place")), "places")
    # Only the first line of each set is looked up, in its document.
    asked = places.select("place.*").groupBy(*of).agg(F.collect_list("line").alias("places"))
    few = places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    bodies = source.join(F.broadcast(asked) if few else asked, of).select("id", "text", "places")
    sets = bodies.mapInArrow(_wanted, "name long, tokens array<long>")
    if not unique:  # copies of a row give the same sets
        sets = sets.groupBy("name").agg(F.any_value("tokens").alias("tokens"))
    sets = materialize(sets, "lines")

    able = F.expr(
        f"least(n, m) * 100 >= greatest(n, m) * {percent}"
        f" AND (1 + least(n - at, m - `on`) - 1) * {100 + percent} >= (n + m) * {percent} AND before < place"
    )
    head = live.groupBy("token").agg(F.min(F.struct("place", "name", "n", "at")).alias("h")).select(
        "token", F.col("h.place").alias("before"), F.col("h.name").alias("other"), F.col("h.n").alias("m"), F.col("h.at").alias("on")
    )
    early = live.join(head, "token").where(able).select("name", "other").distinct()
    found = materialize(_similar(early, sets, percent).select("name").distinct(), "near")
    every = live.select(
        "token", F.col("place").alias("before"), F.col("name").alias("other"), F.col("n").alias("m"), F.col("at").alias("on")
    )
    left = live.join(found, "name", "left_anti").join(every, "token").where(able).select("name", "other").distinct()
    late = _similar(left, sets, percent).select("name").distinct()
    gone = found.unionByName(late)
    return places.join(gone, "name", "left_semi").select(*[f"place.{c}" for c in of], F.col("place.line").alias("place"))


def remove_lines(
    docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", carry: bool = False
) -> DataFrame:
    """One row per row of ``docs``: key, n_lines (with a word), n_removed, ``removed`` line numbers, ``kept`` text.

    A line is what line breaks separate. It is removed when its token set has a Jaccard similarity of
    ``percent`` or more with that of an earlier line (smaller key, or same key and earlier line), judged
    on the input. Lines without a word stay. A NULL text is empty. Copies of a row are one document; other
    texts of a key are documents of their own, in the order of their fingerprints. A NULL key is the smallest.
    Other columns play no part; with ``carry`` the whole row comes along as the struct ``row``, with the text
    replaced by what is kept.
    """
    rest = [c for c in docs.columns if c != text] if carry else []
    boxed = [F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")] if rest else []
    wide = repeats.documents(docs, key, text, *boxed)
    of = repeats.marks(wide.columns)
    source = wide.select("id", "text", *of[1:])
    carried = f", rest {wide.schema['rest'].dataType.simpleString()}" if rest else ""
    marked = "".join(f", {c} long" for c in of[1:])
    sets = materialize(source.mapInArrow(_sets(of), f"key long, whole long, {repeats.typed(of)}, place int"), "sets")
    counts = np.zeros(COUNTERS, np.int64)
    # COUNTERS rows at most, whatever the size of the corpus.
    for row in sets.where("id IS NULL").groupBy("key").agg(F.sum("whole").alias("n")).collect():
        counts[row.key] = row.n
    near = materialize(_near(source, counts, percent, repeats.unique_keys(docs, key)), "near")
    first = repeats.first_places(sets.where("id IS NOT NULL"))
    packed = wide.mapInArrow(K.zipped, "id long, size long, body binary" + marked + carried)
    state = repeats.by_document(packed, ("first", first), ("near", near))
    found = state.mapInArrow(
        _rebuild, "id long, n_lines long, n_removed long, removed array<int>, kept string" + carried
    )
    report = found.select(repeats.own_key(docs, key), "n_lines", "n_removed", "removed", "kept", *(["rest"] if rest else []))
    if not carry:
        return report
    fields = [F.col("kept").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return report.select(key, "n_lines", "n_removed", "removed", "kept", F.struct(*fields).alias("row"))
