"""The pipeline beside its stages worked by hand."""

from __future__ import annotations

import base64
import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken

from driverlens.llm import langid, pii
from fixtures import BASE, ROWS, doc, frame, words
from test_simhash import plain_components, plain_fingerprint


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminated", "masked", "tokens"]


def test_run_beside_brute_force(spark, tmp_path):
    secret = " ".join(words(77, 14).split())
    rows = ROWS + [doc(50, words(50, 30) + " " + secret + " " + words(51, 5)), doc(51, "write to jane [at] example [dot] com " + words(52, 30)), doc(52, "call +1 (555) 123-4567 " + words(53, 30)), doc(53, "123 456")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, secret)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # The learned stage by itself; what it learns is tested on held-out documents.
    model = langid.fit(frame(spark, rows))
    told = {(r.doc_id, r.text) for r in langid.predict(frame(spark, rows), model, score_out="sure").where("lang_pred <> 'und' AND sure >= 0.5").collect()}
    lettered = [r for r in rows if any(map(str.isalpha, r[1] or "")) and (r[0], r[1]) in told]
    assert len(lettered) > 8
    lettered.sort(key=lambda r: (r[0] is None, r[0] or 0))
    roots = plain_components([plain_fingerprint(r[1]) for r in lettered])
    kept = [r for i, r in enumerate(lettered) if roots[i] == i and r[0] != 50]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = pii.Transducers()
    texts = {r[0]: pii.redacted(r[1], sum(found.spans(r[1]), [])) for r in kept}
    assert "[EMAIL]" in texts[51] and "[PHONE]" in texts[52] and BASE in texts.values() and 50 not in texts
    want = {i: (encoding.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items()}
    assert {r.doc_id: (r.ids, r.decoded_sha256) for r in got} == want
    assert len(got) == len(kept) and all(r.n_tokens == len(r.ids) for r in got)


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    docs = frame(spark)
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {(r.score, r.language, r.key) for r in out.collect()} <= {(0.25, "l", "k")}, name
        assert name == "language" or out.count() >= len({r[1] for r in ROWS}) - 4, name
        assert stage(spark, frame(spark, []), str(tmp_path)).collect() == []
