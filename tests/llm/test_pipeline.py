"""The pipeline: stages take effect, keep columns, and survive odd tables."""

import os
import subprocess
import sys

import corpus_pipeline
from skewsafe.llm import simhash
from skewsafe.llm.common import staged, table
from tests.conftest import ROOT, SF_MID, SF_SMALL

from .helpers import ODD_TEXTS, docs
from .test_tokenizing import check_packing


def test_stages_and_run(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "simhash", "pii", "packing"]
    rows = table(spark, SF_MID, "documents")
    sizes = [rows.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, rows, SF_MID), f"test-{name}")
        assert out.columns == rows.columns
        sizes.append(out.count())
        rows = out
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    # The kept documents are of different groups.
    groups = simhash.near_duplicates(table(spark, SF_MID, "documents"))
    kept = groups.join(rows.select("doc_id"), "doc_id")
    assert kept.select("component_id").distinct().count() == kept.count()
    packed = corpus_pipeline.run(spark, SF_MID).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows.select("doc_id").collect()}
    check_packing(packed, 4096)


def test_stages_on_odd_and_empty_tables(spark):
    odd = docs(spark, ODD_TEXTS + ODD_TEXTS, [None, *range(len(ODD_TEXTS) - 1)] * 2)
    for table_ in (odd, odd.where("false")):
        rows = table_
        for name, stage in corpus_pipeline.STAGES:
            rows = staged(stage(spark, rows, SF_SMALL), f"odd-{name}")
        alone = [staged(stage(spark, table_, SF_SMALL), "odd-alone").count() for _, stage in corpus_pipeline.STAGES]
        assert alone[2] <= len(ODD_TEXTS)


def test_the_rest_works_without_these_folders():
    """The entry imports when the llm package and the pipeline cannot be found."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('skewsafe.llm'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())\n"
    )
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, env=env)
