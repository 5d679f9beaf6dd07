"""The pipeline's stages, each held to a plain version of itself."""

import pytest

pytest.importorskip("public_tokenizers")


def test_stages(spark, sf_dir):
    import corpus_pipeline as P
    from gridloom.llm.common import DOCUMENT_COLUMNS
    from tests.llm.test_operators import brute_components

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    named = P.language_stage(spark, docs, sf_dir)
    assert tuple(named.columns) == DOCUMENT_COLUMNS and {r["doc_id"] for r in named.collect()} == set(rows)  # all have letters
    exact = P.exact_stage(spark, docs, sf_dir)
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i]["text"], i)
    assert sorted(r["doc_id"] for r in exact.collect()) == sorted(first.values())
    near = P.near_stage(spark, docs, sf_dir)
    kept = {i for i, _, _, stays in brute_components([(i, r["text"]) for i, r in rows.items()], 5, 80) if stays}
    assert {r["doc_id"] for r in near.collect()} == kept
    clean = {r["doc_id"]: r for r in P.secret_stage(spark, docs, sf_dir).collect()}
    from gridloom.llm.secrets import secret_spans

    for i, r in rows.items():
        want, at = "", 0
        for start, end, _ in secret_spans(r["text"]):
            if start >= at:
                want += r["text"][at:start] + "[SECRET]"
            at = max(at, end)
        assert clean[i]["text"] == want + r["text"][at:]
        assert clean[i]["n_chars"] == len(clean[i]["text"])
    assert len(P.STAGES) == 5


def test_run(spark, sf_dir):
    import corpus_pipeline as P

    import zlib

    import numpy as np
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from gridloom.llm.secrets import secret_spans
    from tests.llm.test_operators import brute_components

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    first = {}
    for i in sorted(docs):
        first.setdefault(docs[i], i)
    kept = [(i, t) for t, i in first.items()]
    kept = {i for i, _, _, stays in brute_components(kept, 5, 80) if stays}
    tokenizer, want = Tokenizer.from_file(path("word_bpe_49k.json")), set()
    for i in kept:
        text, at = "", 0
        for start, end, _ in secret_spans(docs[i]):
            if start >= at:
                text += docs[i][at:start] + "[SECRET]"
            at = max(at, end)
        ids = [*tokenizer.encode(text + docs[i][at:], add_special_tokens=False).ids, 0]
        want |= {(i, k, s, len(p := ids[s : s + 2048]), zlib.crc32(np.array(p, "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 2048))}
    rows = P.run(spark, sf_dir).collect()
    assert {tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows} == want and len(rows) == len(want)
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048
