"""The stages: which documents stay, what happens to texts, and what comes out."""

import re
from pathlib import Path

import corpus_pipeline
from promptloom.storage import materialise
from tests.llm.conftest import TESTDATA, texts_of
from tests.llm.test_documents import brute_components


def test_stages(spark, documents, labels):
    docs, before = documents, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, TESTDATA), "stage")
        assert docs.columns == documents.columns, name
        old, new = texts_of(before), texts_of(docs)
        if name == "minhash near-dedup":
            want = brute_components(old, width=5)
            assert set(new) == {k for k, (_, root) in want.items() if root == k}
        elif name == "pii":
            assert set(new) == set(old) and any("[EMAIL]" in t for t in new.values())
        else:
            assert set(new) < set(old) and all(old[k] == new[k] for k in new)
            gone = before.join(docs.select("doc_id"), "doc_id", "left_anti").join(labels, "doc_id")
            assert gone.filter("quality = 1").count() <= 0.1 * labels.filter("quality = 1").count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA)
    assert {r.doc_id for r in packed.collect()} == set(texts_of(docs))


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13


def test_what_reaches_the_driver():
    """Counts per template word, quantiles and histograms of fixed size, and samples bounded by a parameter."""
    allowed = {"licenses.py": 1, "quality_rules.py": 2, "cotraining.py": 3, "pii.py": 1, "decontamination.py": 1, "lexical.py": 6}
    for path in (Path(corpus_pipeline.__file__).parent / "promptloom" / "llm").glob("*.py"):
        code = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|toPandas|\.rdd\b|toLocalIterator", code), path.name
        assert len(re.findall(r"\.collect\(\)", code)) == allowed.get(path.name, 0), path.name
