"""The stages against plain versions, and what the driver may take away."""

import os
import re
import subprocess
import sys

import numpy as np
import pytest
import sentencepiece
from text_fixtures import awkward, docs_of, empty, WORD, words  # noqa: F401
from test_duplicates import plain_fingerprint, plain_groups
from test_native import plain_mix, plain_repeats

import corpus_pipeline
from tabwright.llm import sentencepiece_viterbi
from tabwright.llm.common import staged

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture
def corpus(docs_of, words):
    rows = [(place, words(40 + place % 9, place % 50), f"s{place % 4}") for place in range(80)]
    rows += [(100, "too short", "s0"), (101, "again and again " * 20, "s1"), (102, words(60, 90) + " mail a.b@c.example", "s2"), (103, None, "s3")]
    return docs_of(rows)


def test_stages_one_by_one(spark, corpus):
    columns = corpus.columns
    kept = stage("quality rules")(spark, corpus, "")
    texts = {row["doc_id"]: row["text"] for row in corpus.collect()}
    sound = {key for key, text in texts.items() if len(found := re.findall(WORD, text or "")) >= 20 and 100 * plain_repeats(text) <= 30 * len(found)}
    assert kept.columns == columns and {row["doc_id"] for row in kept.collect()} == sound

    single = stage("near duplicates")(spark, kept, "")
    keys = sorted(sound)
    groups = plain_groups(np.array([plain_fingerprint(texts[key]) for key in keys], np.uint64))
    left = {keys[at] for at in set(groups)}
    assert single.columns == columns and sorted(row["doc_id"] for row in single.collect()) == sorted(left)

    clean = stage("personal data")(spark, single, "")
    found = {row["doc_id"]: row for row in clean.collect()}
    assert clean.columns == columns and found[102]["text"].endswith("mail [EMAIL]") and found[102]["n_chars"] == len(found[102]["text"])

    mixed = stage("mixing sources")(spark, clean, "")
    rows = mixed.collect()
    assert mixed.columns == columns
    sizes, size, target = plain_mix([(key, row["text"], row["source"]) for key, row in found.items()])
    for source in size:
        taken = sum(len(re.findall(WORD, row["text"])) for row in rows if row["source"] == source)
        assert abs(taken - target[source]) <= 60

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_viterbi.MODEL)
    ids = stage("token ids")(spark, mixed, "").collect()
    assert [row["ids"] for row in ids] == library.encode([row["text"] for row in rows])


def test_order_of_the_mix_is_kept_by_the_written_table(spark, corpus):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = stage("mixing sources")(spark, corpus.repartition(7), "")
        wanted = [row["doc_id"] for row in mixed.collect()]
        written = staged(mixed)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(written.inputFiles()) > 1
    found = stage("token ids")(spark, written, "")
    rows = found.repartition(3).orderBy("mix_part", "mix_place").collect()
    assert [row["doc_id"] for row in rows] == wanted
    assert len({(row["mix_part"], row["mix_place"]) for row in rows}) == len(rows)


def test_stages_on_odd_input(spark, awkward, empty):
    for _, run in corpus_pipeline.STAGES:
        assert run(spark, empty, "").collect() == []
        assert run(spark, awkward, "").count() >= 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run(spark):
    assert corpus_pipeline.run(spark, SF).where("n_tokens = size(ids)").count() > 100


def test_the_rest_works_without_this_part(tmp_path):
    kept = [name for name in os.listdir(ROOT) if name not in (".git", "corpus_pipeline.py", "spark-warehouse")]
    for name in kept:
        os.symlink(os.path.join(ROOT, name), tmp_path / name) if name != "tabwright" else os.mkdir(tmp_path / name)
    for name in os.listdir(os.path.join(ROOT, "tabwright")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "tabwright", name), tmp_path / "tabwright" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(os.path.join(ROOT, "__spark_entry__.py"), encoding="utf-8").read())
    code = "import __spark_entry__ as e; names = e.queries(); assert len(names) > 50 and not any(n.startswith('op') or n == 'pipeline' for n in names)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
