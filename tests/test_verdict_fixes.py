"""NULLs, waves that depend on their user only, and workers that can import the package."""
import os
import subprocess
import sys

from pyspark.sql import functions as F

from cirflow.functions import scalars as S
from cirflow.functions import waves as W
from cirflow.operators import splits as SP
from cirflow.sources import fixtures as FX

from .conftest import SF001, SF01


def test_null_inputs_give_null(spark):
    d = spark.createDataFrame([(5.0, None, [2.0]), (5.0, 0.0, [2.0]), (None, 2.0, [2.0])], "a double, b double, w array<double>")
    got = d.select(S.guarded_ratio("a", "b"), S.monotone_clip("a", "b"), W.wave_normalise("w", "b")).collect()
    assert [tuple(r) for r in got] == [(None, None, [None]), (5.0 / 1e-10, 5.0, [2.0]), (None, None, [1.0])]


def test_rows_of_a_null_class_stay_in_folds(spark):
    d = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(100)], "id int, y int")
    out = SP.stratified_kfold(d, "y", "id", 3).collect()
    assert len(out) == 100 and {r.fold for r in out if r.y is None} == {0, 1, 2}


def test_waves_do_not_depend_on_other_users(spark):
    ev = FX.table(spark, SF01, "events")
    cut = lambda e: {(r.id, tuple(r.w)) for r in FX.user_waves(e, lambda v: v).collect()}
    few = cut(ev.where("user_id % 7 = 0"))
    assert few <= cut(ev) and few
    long = ev.withColumn("user_id", F.lit(1).cast(ev.schema["user_id"].dataType))
    sizes = sorted(len(w) for _, w in cut(long))
    n = ev.count()
    assert sizes == sorted([1016] * (n // 1016) + ([n % 1016] if n % 1016 else []))


def test_workers_import_the_package_from_a_foreign_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as E\n"
            f"print('ROWS', len(E.queries()['second_peak'](s, {SF001!r}).collect()))\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
