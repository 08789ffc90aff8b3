"""Python workers run the operators without a copy of the repository: only the driver has it on its path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
def found(_):
    try:
        import acervo
        yield 1
    except ModuleNotFoundError:
        yield 0
assert spark.sparkContext.parallelize([0], 1).mapPartitions(found).collect() == [0], "the workers have the repository"
from acervo.llm import decontamination, divergence, exact, interaction, lines, maxent, quality, secrets, simhash, substrings
words = " ".join(f"Word{{i % 37}}x line {{i}}" for i in range(90))
docs = spark.createDataFrame([(i, words if i % 3 else f"{{words}} own {{i}}\\n{{words}}", "en", f"s{{i % 12}}") for i in range(40)], "doc_id long, text string, lang string, source string")
bench = spark.createDataFrame([(1, words[:200])], "item_id long, text string")
labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
for made in (lines.deduplicated(docs), decontamination.judged(docs, bench, whole=True), decontamination.judged(docs, bench, most=0), maxent.scored(docs, rounds=1), substrings.deduplicated(docs), simhash.deduplicated(docs), simhash.grouped(docs),
             exact.deduplicated(docs), interaction.audited(docs, labels), divergence.diverging(docs, 2), quality.judged(docs, quality.train(docs, labels)), secrets.scanned(docs)):
    assert made.count()
print("all ran")
"""


def test_workers_need_no_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS", "SPARK_HOME")}
    tokenizers = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and os.path.abspath(p) != ROOT]
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tmp_path, env=env | ({"PYTHONPATH": ":".join(tokenizers)} if tokenizers else {}), capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-3000:]
