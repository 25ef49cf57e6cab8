"""Python tasks run where the package is not installed."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from newslake import build_session
from newslake.functions.embedding import vector
from newslake.operators import answers, search
from pyspark.sql import functions as F
spark = build_session(**{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
texts = spark.range(40).select(F.col("id"), vector(F.concat(F.lit("t "), "id"), lambda: lambda t: [[len(x), 1.0] for x in t]).alias("values"))
asked = texts.select(F.col("id").alias("q_id"), "values")
for numbers in (10000, 80):
    assert search.nearest(texts, asked, 2, broadcast_numbers=numbers).count() == 80
prompts = spark.createDataFrame([("p", None)], "prompt string, fallback_answer string")
assert answers.answered(prompts, lambda t: t + "!").first().answer == "p!"
print("done")
"""


def test_workers_need_no_copy(tmp_path):
    repo = str(Path(__file__).parent.parent)
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)],
        cwd=tmp_path, capture_output=True, text=True, timeout=180,
    )
    assert "done" in run.stdout, run.stderr[-2000:]
