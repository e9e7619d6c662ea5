"""The pipeline's stages, each on what the one before kept, against what the operators say."""

from collections import Counter, defaultdict

import corpus_pipeline
from doctriage.llm import exact_dedup, language, mixing, simhash
from doctriage.session import materialize

SF = "/root/testdata/sf0.001"


def repeated_rows():
    """Fully repeated rows, ids with several texts, and many rows without an id."""
    words = [" ".join(f"w{i}x{j % 9}" for j in range(6 + i % 5)) for i in range(30)]
    rows = [(i, words[i], "en", "ab"[i % 2]) for i in range(12)]
    rows += rows[:4] * 3 + [(i, words[i + 1] + " ", "en", "a") for i in range(4)] + [(3, words[20], "en", "b")] * 2
    return rows + [(None, words[i % 15 + 15], "en", "abc"[i % 3]) for i in range(40)] + [(None, words[0], "en", "a")] * 3


def test_exact_keeps_one_row_a_class(frame):
    rows = repeated_rows()
    norm = lambda t: "".join(t.split())
    best = {}
    for d, t, *_ in rows:
        best[norm(t)] = min(best.get(norm(t), (0, True, 0)), (-len(t), d is None, d or 0))
    got = Counter((norm(r.text), (-len(r.text), r.doc_id is None, r.doc_id or 0))
                  for r in exact_dedup.keep_one(frame(rows)).collect())
    assert got == Counter(best.items())


def test_near_keeps_one_row_a_component(frame):
    rows = repeated_rows()
    fp = [simhash.fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    while True:
        new = [min(root[j] for j in range(len(rows)) if (int(fp[i]) ^ int(fp[j])).bit_count() <= 2) for i in range(len(rows))]
        if new == root:
            break
        root = new
    least = {}
    for r, f, (d, *_) in zip(root, fp, rows):
        least[r] = min(least.get(r, (True, 1 << 62)), (d is None, d or 0))
    place = {t: r for r, (_, t, *_) in zip(root, rows)}
    got = Counter((place[r.text], (r.doc_id is None, r.doc_id or 0)) for r in simhash.keep_one(frame(rows)).collect())
    assert got == Counter(least.items())


def test_mix_gives_each_row_its_own_copies(frame):
    rows = repeated_rows()
    plan = mixing.mix(frame(rows)).collect()
    got = mixing.mixed_documents(frame(rows)).collect()
    # copies and words, by id and source, as the plan has them row by row
    assert len(got) == sum(-(-r.taken // r.size) for r in plan if r.taken)
    whole, cut = Counter(), Counter()
    for r in plan:
        whole[r.doc_id, r.size] += r.taken // r.size if r.size else 0
        if r.size and r.taken % r.size:
            cut[r.doc_id, r.taken % r.size] += 1
    texts = {t for _, t, *_ in rows}
    assert Counter((r.doc_id, len(r.text.split())) for r in got if r.text in texts) == +whole
    assert Counter((r.doc_id, len(r.text.split())) for r in got if r.text not in texts) == cut
    most = Counter(x[:4] for x in rows)
    seen = Counter((r.doc_id, r.text, r.lang, r.source) for r in got if r.text in texts)
    assert all(n <= 2 * most[k] for k, n in seen.items())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.dtypes
    seen = {}
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        before[name] = docs
        docs = materialize(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != "packing":
            assert docs.dtypes == names
    ids = {k: {r.doc_id for r in v.select("doc_id").collect()} for k, v in seen.items()}
    found = language.identify(before["language_id"], language.fit(before["language_id"]))
    assert ids["language_id"] == {r.doc_id for r in found.filter("lang_pred != 'und'").collect()}
    assert ids["exact_dedup"] == {r.keep_id for r in exact_dedup.exact_duplicates(before["exact_dedup"]).collect()}
    assert ids["near_dedup"] == {r.component_id for r in simhash.near_duplicates(before["near_dedup"]).collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix(before["source_mix"]).collect() if r.taken}
    words = defaultdict(int)
    for r in seen["source_mix"].collect():
        words[r.doc_id] += len(r.text.split())
    assert words == taken
    packed = Counter()
    for r in docs.collect():
        packed[r.doc_id] += r.length
    assert set(packed) == set(taken) and all(v > 0 for v in packed.values())
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_empty_table_and_no_labels(spark, frame):
    for rows in ([], [(i, f"text number {i} of some", None, "a") for i in range(20)]):
        docs = frame(rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), name)
            if name == "language_id":
                assert docs.count() == len(rows)
        assert (docs.count() > 0) == (len(rows) > 0)
