"""Version order against the system's ``sort -V``."""

import random
import shutil
import subprocess

import pytest

from markerloom.functions import scalars as s


def test_version_order_by_hand(spark):
    names = ["c1.10", "c1.2", "c10", "c2", "c1", "c01", "c001.2", "c1~", "c1a", "c1-2", "c1.2.10", "c1.2.9", "", "chr1.la", "chr10.la", "chr2.la", "x99999999999999999999999", "x100000000000000000000000"]
    got = [r.name for r in s.natural_sort(spark.createDataFrame([(n,) for n in names], "name string"), "name").collect()]
    before = lambda a, b: got.index(a) < got.index(b)
    assert before("c1.2", "c1.10") and before("c1.2.9", "c1.2.10") and before("c2", "c10") and before("c1~", "c1") and before("c1", "c1a") and before("c1a", "c1-2")
    assert before("chr2.la", "chr10.la") and before("x99999999999999999999999", "x100000000000000000000000") and got[0] == ""


@pytest.mark.skipif(not shutil.which("sort"), reason="no sort command")
def test_version_order_as_the_command(spark):
    rng = random.Random(3)
    names = {"".join(rng.choice(["c", "ctg", "1", "2", "10", "02", "007", ".", "-", "_", "~", "a", "B", ".la", ".gz"]) for _ in range(rng.randint(1, 7))) for _ in range(600)}
    names = sorted(n for n in names if not n.startswith("."))
    run = subprocess.run(["sort", "-V"], input="\n".join(names) + "\n", capture_output=True, text=True, env={"LC_ALL": "C", "PATH": "/usr/bin:/bin"})
    if run.returncode:
        pytest.skip("sort knows no version order")
    got = [r.name for r in s.natural_sort(spark.createDataFrame([(n,) for n in names], "name string"), "name").collect()]
    assert got == run.stdout.split("\n")[:-1]
