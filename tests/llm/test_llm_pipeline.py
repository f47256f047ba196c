"""The corpus pipeline against a plain version of every stage, and the guard of the entry."""

import os
import subprocess
import sys

import sentencepiece

import corpus_pipeline as c
from test_llm_jaccard import brute as group_rows
from test_llm_mixing import brute as mix_rows
from veritab.llm import pieces, secret_scan, toxicity
from veritab.llm.common import table

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(spark, docs, sf_dir):
    """(doc_id, ids) of every row of the result, a document at a time."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.learn(table(spark, sf_dir, "documents"), labels)
    tag = toxicity.Tagger(model)
    rows = [r for r in docs if tag([r[1] or ""])[0][0] < 0.3]
    _, group = group_rows([(r[0], r[1]) for r in rows], 5, 80)
    best = {}
    for r, g in zip(rows, group):
        if g not in best or r[0] < best[g][0]:
            best[g] = r
    rows = list(best.values())
    scan, clean = secret_scan.Scanner(), []
    for i, text, source in rows:
        for kind, a, b in reversed(secret_scan.merged(scan(text or ""))):
            text = text[:a] + f"[{kind}]" + text[b:]
        clean.append((i, text, source))
    weights = {r["doc_id"]: 1.0 if r["quality"] else 0.25 for r in labels.collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts, out = {r[0]: r[1] for r in clean}, []
    for i, n, _, _, taken in mix_rows(clean, weights, split_last=False):
        out += [(i, library.encode(texts[i] or ""))] * (taken // n if n else 1)
    return sorted(out)


def test_run_matches_the_plain_version(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SF, "documents").collect()]
    got = c.run(spark, SF)
    rows = got.collect()
    assert sorted((r["doc_id"], r["ids"]) for r in rows) == plain(spark, docs, SF)
    assert rows and all(r["round_trip"] for r in rows)


def test_stages_return_the_columns_of_documents_and_take_empty_tables(spark):
    empty = table(spark, SF, "documents").limit(0)
    assert [n for n, _ in c.STAGES] == ["toxicity", "ngram_jaccard_join", "secret_scan", "mixing", "sentencepiece"]
    for k, (_, stage) in enumerate(c.STAGES):
        out = stage(spark, empty, SF)
        assert out.collect() == []
        if k < len(c.STAGES) - 1:
            assert out.columns == empty.columns and out.dtypes == empty.dtypes


def test_entry_works_without_the_corpus_part():
    code = ("import sys\nclass Gone:\n    def find_spec(self, name, *a):\n"
            "        if name in ('veritab.llm', 'corpus_pipeline'): raise ImportError(name)\n"
            "sys.meta_path.insert(0, Gone())\nimport __spark_entry__ as e\n"
            "assert len(e.queries()) == len(e.oracle_sql()) >= 30\n"
            "assert not any(k.startswith('op') or k == 'pipeline' for k in e.queries())\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
