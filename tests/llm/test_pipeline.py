from collections import Counter

import corpus_pipeline
from braidwork.llm.mixing import mix_sources
from braidwork.llm.quality import quality_rules
from tests.llm.test_simhash import brute_components, brute_print
from tests.llm.test_suffixes import brute_spans


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    current = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    frame = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{id(frame)}-{k}"
        stage(spark, frame, sf_dir).write.parquet(path)
        frame = spark.read.parquet(path)
        if name == "near_duplicates":
            ids = sorted(current)
            parts = brute_components([(i, brute_print(current[i])) for i in ids])
            current = {i: current[i] for i, c in parts if i == c}
        if name == "repeated_text":
            ids = sorted(current)
            texts = [current[i].encode() for i in ids]
            cut = {i: bytes(x for x, g in zip(t, gone, strict=True) if not g).decode(errors="replace") for i, t, gone in zip(ids, texts, brute_spans(texts, 200), strict=True)}
            current = {i: t for i, t in cut.items() if t.split()}
            before_mix = frame
        if name in ("quality_rules", "near_duplicates", "repeated_text"):
            assert frame.columns == columns
            assert Counter((r.doc_id, r.text) for r in frame.collect()) == Counter(current.items()), name
        if name == "source_mixing":
            assert frame.columns == columns
            taken = {r.doc_id: r.taken for r in mix_sources(before_mix).collect()}
            got: dict = {}
            for r in frame.collect():
                got.setdefault(r.doc_id, []).append(r.text)
            assert {i: sum(len(t.split()) for t in ts) for i, ts in got.items()} == {i: n for i, n in taken.items() if n}
            for i, ts in got.items():
                assert all(current[i].strip().startswith(t.strip()) for t in ts) and len(ts) <= 2
            mixed = frame
    assert frame.count() == mixed.count()
    assert frame.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_keep_columns_of_any_name(spark, make_docs):
    odd = ["copies", "kept", "_id", "_h", "_hash", "_t1", "_t2", "fp", "_row", "row", "left_over", "t1", "t2", "_words", "size", "a.b", "tick`s", "_row.text", "two words"]
    text = " ".join(f"word{k} the" for k in range(80))
    docs = make_docs([(1, text), (2, text), (3, text.replace("word", "other")), (None, "short")]).selectExpr("*", *["'{}' as `{}`".format(c, c.replace("`", "``")) for c in odd])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert all(r[c] == c for r in out.collect() for c in odd), name
