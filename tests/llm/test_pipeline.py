"""The pipeline against a brute-force version of its five stages."""

import hashlib
import re

from brute_mixing import mix
from tokenizers import Tokenizer

import corpus_pipeline
from test_operators import PATH, brute_components, brute_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _sha string"


def brute(rows: list[dict]) -> list[tuple]:
    rows = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    best = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r)
    rows = list(best.values())
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    root = brute_components(prints.values(), 2)
    least = {}
    for i, p in prints.items():
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    rows = [r for r in rows if least.get(root[prints[r["doc_id"]]]) == r["doc_id"]]
    kept = [(r["doc_id"], r["text"]) for r, _, chosen in mix(rows) if chosen]
    library = Tokenizer.from_file(PATH)
    out = []
    for i, text in kept:
        ids = library.encode(text, add_special_tokens=False).ids
        out.append(
            (
                i,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=repr)


def test_pipeline_matches_brute_force(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [r.asDict() | {"_sha": "clash"} for r in given]
    near = dict(rows[3], doc_id=90_001, text=rows[3]["text"].replace(" ", "\n", 1))
    rows += [
        dict(rows[0], doc_id=90_000),  # exact copy under another id
        dict(rows[1]),  # repeated row
        near,  # equal after normalising
        dict(rows[2], doc_id=90_002, text=None),
        dict(rows[2], doc_id=90_003, text=""),
        dict(rows[2], doc_id=90_004, text="123 456 !!"),
        dict(rows[2], doc_id=90_005, text="word " * 20_000, lang=None, source=None),
    ]
    spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = result(corpus_pipeline.run(spark, str(tmp_path)))
    assert got == brute(rows) and 0 < len(got) < len(given)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "unused")
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").collect() == []
