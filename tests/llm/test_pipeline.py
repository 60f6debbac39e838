"""The pipeline against brute-force versions of its stages, and the entry points."""

import os
import random

import public_tokenizers as P
import pytest

import corpus_pipeline
from tests.llm.test_native_ops import brute_rules
from tests.llm.test_near_and_quality import brute_classes
from tests.llm.test_token_ops import check_packing, library


@pytest.fixture()
def folder(spark, scratch, corpus):
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefghijkl") + str(rng.randrange(900))
    docs = [(d, t, "en", rng.choice(["a", "b"]), len(t or "")) for d, t in corpus[::4]]
    passage = " ".join(word() for _ in range(40))
    for i in range(120):
        text = " ".join(word() for _ in range(rng.randrange(30, 200))) + "\n" * (i % 3) + (passage if i % 4 == 0 else "")
        docs.append((10_000 + i, text, "en", "a", len(text)))
    for i in range(40):
        text = " ".join(word() + "###" for _ in range(60))
        docs.append((20_000 + i, text, "en", "b", len(text)))
    docs += [(30_000, docs[-50][1], "en", "a", 1), (30_001, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    labels = [(d[0], int("###" not in (d[1] or "")), 0) for d in docs]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    return scratch


def cut(docs, width=100):
    seen, out = set(), {}
    for d, t in sorted(docs):
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if b[i : i + width] in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(b[i : i + width])
        out[d] = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    ruled = corpus_pipeline.quality_rules(spark, docs, folder)
    want = {r[0] for r in brute_rules([(r.doc_id, r.text, r.source) for r in rows.values()]) if r[7]}
    assert ruled.columns == columns and {r.doc_id for r in ruled.collect()} == want and 0 < len(want) < len(rows)
    good = corpus_pipeline.quality_classifier(spark, ruled, folder)
    good_ids = {r.doc_id for r in good.collect()}
    assert good.columns == columns and good_ids == {d for d in want if "###" not in rows[d].text}
    single = corpus_pipeline.near_duplicates(spark, good, folder)
    classes = brute_classes([(d, rows[d].text) for d in good_ids])
    left = set(classes.values())
    assert single.columns == columns and {r.doc_id for r in single.collect()} == left and len(left) < len(good_ids)
    clean = corpus_pipeline.repeated_passages(spark, single, folder)
    texts = cut([(d, rows[d].text) for d in left])
    assert clean.columns == columns and {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {d: (t, len(t)) for d, t in texts.items()}
    packed = corpus_pipeline.run(spark, folder).collect()
    check_packing(packed, list(texts.items()), library("byte_bpe_50k.json"), 1024)
    assert {r.doc_id for r in packed} == left


def test_registered():
    import __spark_entry__ as entry

    names = [x for x in entry.queries() if x.startswith("op") and x[2].isdigit()]
    assert sorted(int(x[2:].split("_")[0]) for x in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_entry_imports_without_the_subpackage(scratch):
    """The rest works when the llm folder and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = f"{scratch}/copy"
    shutil.copytree(f"{root}/marketlens", f"{copy}/marketlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "duckdb_twins.py"):
        shutil.copy(f"{root}/{name}", copy)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 54 and not any(x.startswith('op1_') for x in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": copy}, timeout=120)
