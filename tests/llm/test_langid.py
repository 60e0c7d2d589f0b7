import tracemalloc
import zlib

import numpy as np

from tests.conftest import SF_SMALL
from tests.llm.cases import empty, frame
from tidemark.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(held) > 30
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)


def test_undetermined_and_null(spark):
    found = langid.identify(frame(spark)).collect()
    assert len(found) == frame(spark).count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 19, 20))
    assert by_id[10].lang_pred == "en"
    kept = langid.keep_known(frame(spark))
    assert kept.columns == frame(spark).columns
    assert kept.count() == sum(r.lang_pred != "und" for r in found)


def test_only_learned_rows_count(spark):
    docs = [(i, "zug und bahn", "de") for i in range(40)] + [(i, "train and rail", "en") for i in range(40, 80)]
    held = [i for i in range(100, 300) if zlib.crc32(str(i).encode()) % 4 == 2]
    base = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    more = spark.createDataFrame([(i, "zug und bahn", "xx") for i in held], base.schema)
    assert {r.lang_pred for r in langid.identify(base.unionByName(more)).collect()} == {"de", "en"}


def test_empty_and_unlabelled(spark):
    assert langid.identify(empty(spark)).collect() == []
    plain = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(plain).collect()] == [("und", 0.0)]
    assert langid.keep_known(plain).count() == 1


def test_folded_matrix_equals_plain_kernel_ridge(spark):
    """With every learned text as a landmark the map is exact: the same outputs as kernel ridge on the whole kernel."""
    docs = spark.read.parquet(SF_SMALL + "/documents.parquet").filter("n_chars between 40 and 1800").select("doc_id", "text", "lang").collect()
    names, matrix = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), landmarks=10_000)
    learned = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 != 2]

    def grams(text):
        """The hashed n-grams of a text, one by one."""
        raw = f" {langid.OTHER.sub(' ', text.lower())} ".encode()
        out = set()
        for n in langid.SPECTRUM:
            for i in range(len(raw) - n + 1):
                code = 1
                for b in raw[i:i + n]:
                    code = (code << 8) | b
                out.add((code * int(langid.MIX) & (1 << 64) - 1) >> 64 - langid.BITS)
        return out

    sets = {d.text: grams(d.text) for d in docs}

    def kernel(a, b):
        return np.array([[len(sets[x.text] & sets[y.text]) / np.sqrt(len(sets[x.text]) * len(sets[y.text])) for y in b] for x in a])

    sizes = {n: sum(d.lang == n for d in learned) for n in names}
    weight = np.array([sizes[d.lang] for d in learned], float)
    y = np.array([[1.0 if d.lang == n else -1.0 for n in names] for d in learned])
    solved = np.linalg.solve(kernel(learned, learned) + 1 + np.diag(weight) * langid.RIDGE * len(names) / len(learned), y)
    asked = docs[:60]
    want = (kernel(asked, learned) + 1) @ solved
    got = langid.normalised(langid.presence([d.text for d in asked])) @ matrix[:-1] + matrix[-1]
    assert len(learned) > 40 and np.abs(got - want).max() < 0.02
    assert (got.argmax(axis=1) == want.argmax(axis=1)).all()


def test_fitting_holds_no_unpacked_sample(spark):
    """A sample of 2,251 rows, each 64 KB as floats: 148 MB, and once more while it is normalised."""
    rows = [(i, f"{'zug und bahn' if i % 2 else 'train and rail'} {i}", "de" if i % 2 else "en") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        names, matrix = langid.fit(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert names == ["de", "en"] and matrix.shape == ((1 << langid.BITS) + 1, 2)
    assert peak < 130e6


def test_kernel_in_parts_equals_whole_kernel():
    found = np.random.default_rng(3).random((2 * langid.ROWS + 5, 1 << langid.BITS)) < 0.02
    bits, rows = np.packbits(found, axis=1), langid.normalised(found)
    assert np.allclose(langid.kernel(bits, langid.unpacked(bits[:40])), rows @ rows[:40].T, atol=1e-6)
