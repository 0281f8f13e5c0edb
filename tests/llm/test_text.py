"""Pieces, spelling variants and periodic runs against the library, plain versions and awkward tables."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import ROWS, SF_DIR, WIDE, prose

from scrub.llm import kernels as K
from scrub.llm import contamination, neardup, periods, pieces, queries, spelling


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(k, t, 1, "k", 2, None, "r", 3, 4) for k, t in ROWS], WIDE).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], WIDE)


@pytest.fixture(scope="module")
def given_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_bpe())


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- 11: pieces -----------------------------------------------------------------------------------

ODD = [*"abe  \n\t.,12", "é", "中", "😀", "▁", "▁▁", "\x01", "\x00", "</s>", "<unk>", "<0x41>", "the", "ing", "　", "Ａ", "ﾊﾞ", "ﷺ", "é", "ﬁ", "½", "\xa0", "​", "�"]


def odd_texts(n, seed):
    random.seed(seed)
    return ["".join(random.choices(ODD, k=random.randint(0, 40))) for _ in range(n)] + ["", "   ", " a", "a ", "▁ ", " ▁"]


def texts_of(texts):
    coded = [t.encode() for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8), np.append(0, np.cumsum([len(t) for t in coded])).astype(np.int64)


def told(codec, texts):
    """(ids, spans) of each text, by the codec."""
    data, at = texts_of(texts)
    ids, begins, ends, before = codec.encode(data, at)
    return [
        (ids[x:y].tolist(), [(int(b - a), int(e - a)) for b, e in zip(begins[x:y], ends[x:y])])
        for a, x, y in zip(at, before, before[1:])
    ]


def plain(processor, texts):
    found = [processor.encode(t.encode(), return_type="offset_mapping") for t in texts]
    return [(list(f["ids"]), list(f["offsets"])) for f in found]


def test_ids_and_spans_are_the_library_s(library):
    texts = odd_texts(1500, 1)
    assert told(pieces.Codec(queries.piece_bpe()), texts) == plain(library, texts)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("extra", [True, False])
def test_compiled_maps(rule, extra, tmp_path):
    """Under maps that replace, add and take away characters, with and without removal of blanks."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(queries.piece_bpe(), "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    said = proto.NormalizerSpec.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    model.normalizer_spec.precompiled_charsmap = said.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = extra
    path = tmp_path / "own.model"
    path.write_bytes(model.SerializeToString())
    processor, codec = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Codec(str(path))
    texts = odd_texts(1500, 2)
    assert told(codec, texts) == plain(processor, texts)
    # Stretches of a long text give what the whole gives.
    data, _ = texts_of(["é ﾊﾞ　 ".join(odd_texts(400, 3))])
    whole = codec.encode(data, np.array([0, len(data)]))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(K, "CHUNK_BYTES", 300)
        cuts = codec.parts(data)
    assert len(cuts) > 10
    found = [codec.encode(data[a:b], np.array([0, b - a]), np.array([a == 0]), np.array([b == len(data)])) for a, b in zip(cuts, cuts[1:])]
    assert np.concatenate([x[0] for x in found]).tolist() == whole[0].tolist()
    assert np.concatenate([x[1] + a for x, a in zip(found, cuts)]).tolist() == whole[1].tolist()


def test_decoding_in_parts(library):
    codec = pieces.Codec(queries.piece_bpe())
    random.seed(4)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "IDS_AT_ONCE", 20)
        for text in odd_texts(300, 5):
            ids = library.encode(text + " of the corpus " + text)
            assert codec.decode(np.array(ids)) == library.decode(ids)
        for _ in range(300):
            ids = random.choices(range(len(library)), k=random.randint(0, 200))
            assert codec.decode(np.array(ids, int)) == library.decode(ids)


def test_piece_query(spark, awkward, empty, given_rows, library):
    def expected(rows):
        out = []
        for key, text in rows:
            ids = library.encode(text or "")
            out.append((key, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids))))
        return sorted(out, key=repr)

    digests = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert bag(queries.QUERIES["op11_piece_encoding"](spark, SF_DIR), *digests) == expected(given_rows)
    long = " ".join(prose(8, 400_000))
    rows = [*ROWS, (77, long), (78, "x" * 300_000)]
    docs = awkward.unionByName(spark.createDataFrame([r for r in rows if r not in ROWS], "doc_id long, text string"), allowMissingColumns=True)
    encoded = pieces.encode(docs, queries.piece_bpe())
    assert encoded.columns == ["doc_id", "n_bytes", "ids", "begins", "ends"]
    ids = F.col("ids")
    found = pieces.decode(encoded, queries.piece_bpe())
    assert bag(found, "doc_id", F.size(ids), pieces.digest(ids), F.sha2("decoded", 256)) == expected(rows)
    # The model takes nothing away, so spans follow each other from the first byte to the last.
    for r in encoded.where("doc_id <> 77").collect():
        assert [0, *r.ends][:-1] == r.begins and (r.ends or [0])[-1] == r.n_bytes
    assert pieces.decode(pieces.encode(empty, queries.piece_bpe()), queries.piece_bpe()).count() == 0
    other = spark.createDataFrame([("k", None, 1), (None, "a b", 2)], "doc_id string, text string, ids int")
    assert pieces.encode(other, queries.piece_bpe()).count() == 2


# --- 12: spelling variants ------------------------------------------------------------------------


def test_spelling_query(spark, given_rows):
    mine = queries.QUERIES["op12_spelling_variants"](spark, SF_DIR)
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in mine.collect()}
    assert found == brute.variants(brute.vocabulary(given_rows))


def test_words_are_counted_whole(spark, awkward, empty):
    rows = [(None, "Straße STRASSE naïve×÷Öl"), (5, "abcdefg ABCDEFG abcdefG 1abcdefg2"), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for at_least, every in ((1, 1), (1, 3), (3, 199)):
        words = spelling.with_typos(spelling.runs(docs, at_least=at_least), every)
        mine = {r.word: r.n for r in spelling.vocabulary(words, min_length=3, min_count=1).collect()}
        assert mine == brute.vocabulary(rows, every, 3, 1)
    words = spelling.with_typos(spelling.runs(awkward), 199)
    assert {r.word: r.n for r in spelling.vocabulary(words, min_length=3, min_count=2).collect()} == brute.vocabulary(ROWS, 199, 3, 2)
    assert spelling.variants(spelling.vocabulary(spelling.with_typos(spelling.runs(empty), 199))).count() == 0


@pytest.mark.parametrize("letters, longest, many", [("ab", 9, 500), ("abcé", 6, 1500), ("abcdefgh", 4, 1500), ("\x00😀a", 5, 150)])
def test_all_near_pairs_are_found_once(spark, letters, longest, many):
    """Vocabularies so dense that lists are long and every kind of edit occurs."""
    random.seed(len(letters))
    n_of = {"".join(random.choices(letters, k=random.randint(1, longest))): random.choice([1, 2, 5, 30, 200, 2000]) for _ in range(many)}
    words = spark.createDataFrame(list(n_of.items()), "word string, n long")
    pairs = [tuple(r) for r in spelling.near_words(words).select("word", "other").collect()]
    assert len(pairs) == len(set(pairs))
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words).collect()}
    assert found == brute.variants(n_of)


def test_rows_of_the_matrix(spark):
    """One list, scanned by words of every length."""
    random.seed(9)
    words = sorted({"".join(random.choices("abc", k=random.randint(0, 7))) for _ in range(900)})
    common = [0, *map(spelling.shared, words, words[1:])]
    for query in words[::7] + ["", "cccccccc"]:
        assert [words[i] for i in spelling.near_one(words, common, query)] == [w for w in words if brute.one_edit(query, w)]


def test_lists_that_go_over_batches(spark):
    base = [a + b + "stem" + c for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        words = spark.createDataFrame([(w, 10 ** (i % 4)) for i, w in enumerate(base)], "word string, n long")
        found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(words).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute.variants({w: 10 ** (i % 4) for i, w in enumerate(base)})


# --- 13: periodic runs ----------------------------------------------------------------------------


def test_run_query(spark, given_rows):
    mine = queries.QUERIES["op13_periodic_runs"](spark, SF_DIR)
    columns = [c for c in mine.columns if c not in ("doc_id", "n_words")]
    assert columns == ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = {r.doc_id: tuple(r[c] for c in columns) for r in mine.collect()}
    assert found == {key: brute.run_digests(key, text) for key, text in given_rows}
    assert any(x[0] for x in found.values())


def word_soup(n, seed):
    random.seed(seed)
    for _ in range(n):
        few, words = random.choice([1, 2, 3, 50]), []
        while len(words) < random.randint(0, 260):
            if random.random() < 0.5:
                words += [random.randrange(few) for _ in range(random.randint(1, 30))]
            else:
                passage = [random.randrange(few) for _ in range(random.randint(1, 60))]
                words += (passage * random.randint(2, 9))[:random.randint(1, 200)]
        yield [f"w{x}" for x in words]
    yield from (["a"] * 24, ["a"] * 23, ["a", "b"] * 12, ["a"] * 900 + ["b"] + ["a"] * 900, [])


@pytest.mark.parametrize("min_words, repeats", [(24, 3), (6, 3), (10, 4), (1, 3)])
def test_runs_of_every_kind(min_words, repeats):
    docs = list(word_soup(300, 3))
    names = {w: i for i, w in enumerate({w for d in docs for w in d})}
    values = K.mix(np.array([names[w] for d in docs for w in d], np.uint64))
    first = np.append(0, np.cumsum([len(d) for d in docs]))
    found = periods.runs_of(values, first, min_words, repeats)
    assert found == [(i, *r) for i, d in enumerate(docs) for r in brute.runs(d, min_words, repeats)]


def test_runs_of_documents(spark, awkward, empty):
    found = periods.find_runs(awkward)
    columns = ("doc_id", "n_words", "collapsed")

    def expected(rows):
        out = []
        for key, text in rows:
            w = brute.words(text)
            gone = {i for start, length, q in brute.runs(w) for i in range(start + q, start + length)}
            out.append((key, len(w), " ".join(x for i, x in enumerate(w) if i not in gone)))
        return sorted(out, key=repr)

    rows = [r for r in ROWS if r[0] != 19]
    assert bag(found.where("doc_id IS NULL OR doc_id <> 19"), *columns) == expected(rows)
    assert found.where("doc_id = 14").first().runs == [(0, 700, 1)]
    assert periods.find_runs(empty).count() == 0
    other = spark.createDataFrame([("k", None), (None, "a b"), ("k", " x" * 40), ("k", " x" * 40)], "doc_id string, text string")
    assert sorted(r.n_words for r in periods.find_runs(other).collect()) == [0, 2, 40, 40]
    with pytest.raises(ValueError):
        periods.find_runs(other, repeats=2)


def test_one_very_long_document(spark):
    """Over two megabytes: a passage of 30,000 words five times, then one word 200,000 times."""
    passage = prose(12, 30_000)
    words = passage * 5 + ["x"] * 200_000
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "short")], "doc_id long, text string")
    row = periods.find_runs(docs).where("doc_id = 1").first()
    assert [tuple(r) for r in row.runs] == [(0, 150_000, 30_000), (150_000, 200_000, 1)]
    assert row.collapsed == " ".join([*passage, "x"])
    best = periods.find_runs(docs).select("doc_id", periods.strongest(F.col("runs")).alias("best"))
    assert {r.doc_id: r.best and tuple(r.best) for r in best.collect()} == {1: (150_000, 200_000, 1), 2: None}


# --- columns of any name --------------------------------------------------------------------------


def test_filters_of_documents_with_names_of_their_own(spark):
    """Columns that are called like those the filters use inside."""
    text, item = " ".join(prose(41, 60)), " ".join(prose(42, 30))
    rows = [(1, text), (2, text), (3, item + " " + " ".join(prose(43, 9))), (4, " ".join(prose(44, 40)))]
    names = ("_bad", "_extra", "_doc", "_item", "item", "class_id", "node")
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(n).alias(n) for n in names])
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    clean = contamination.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 4]
    assert {r._bad for r in clean.collect()} == {"_bad"}
