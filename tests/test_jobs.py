"""Jobs: growing input, failures between their writes, reruns, odd rows, and the command line."""

import json
import os
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import cohort_release, patch_intake, registry
from jobs.common import settings
from spatialfeat.operators import intensity

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parents[1]
DOCS = "doc_id long, text string, source string"


def rows_of(df):
    return sorted(map(repr, df.collect()))


def plain(rows):
    """(sample, patch) -> what a plain count of bytes says, of rows (doc_id, text, source)."""
    out, by = {}, defaultdict(Counter)
    for i, text, source in rows:
        data = None if text is None else text.encode()
        inside = [b for b in data or b"" if 30 < b < 220]
        status = "error" if data is None else "ok" if len(inside) >= 50 else "skipped_small_mask"
        out[source or None, i] = (None if data is None else len(data), None if data is None else len(inside), sum(inside) / len(inside) if inside else None, status)
        if status == "ok":
            by[source or None].update(data)
    stats = {}
    for s, c in by.items():
        n, total = sum(c.values()), sum(k * v for k, v in c.items())
        cut = lambda p, c=c, n=n: next(k for k in sorted(c) if sum(v for j, v in c.items() if j <= k) >= p * n)
        apart = {}
        for k in sorted(c):
            low, sum_low = sum(v for j, v in c.items() if j <= k), sum(j * v for j, v in c.items() if j <= k)
            if low < n:
                apart[k] = (n * sum_low - total * low) ** 2 / (low * (n - low))
        stats[s] = (n, total / n, cut(0.01), cut(0.5), cut(0.99), max(apart, key=lambda k, a=apart: (a[k], -k)) if apart else None)
    return out, stats


def check(spark, out, rows):
    patches, stats = plain(rows)
    got = {(r.sample_id, r.patch_idx): r for r in patch_intake.output(spark, out).collect()}
    assert got.keys() == patches.keys()
    for key, r in got.items():
        assert (r.n_pixels, r.mask_area, r.mask_mean, r.status) == (*patches[key][:2], pytest.approx(patches[key][2]), patches[key][3])
        own = [v for k, v in patches.items() if k[0] == key[0]]
        assert (r.sample_patches, r.sample_ok, r.sample_error) == (len(own), sum(v[3] == "ok" for v in own), sum(v[3] == "error" for v in own))
        seen = (r.sample_pixels, r.sample_mean, r.sample_p01, r.sample_p50, r.sample_p99, r.sample_threshold)
        want = stats.get(key[0], (None,) * 6)
        assert seen == (want[0], pytest.approx(want[1]), *want[2:])


FIRST = [(1, "dark " * 30, "a"), (2, "é漢字😀" * 40, "a"), (3, None, "b"), (4, "", "b"), (5, "short", None), (6, "x" * 60, "7"), (None, "no id " * 20, "")]
SECOND = [(1, "BRIGHT~~" * 20, "a"), (8, "more " * 40, "b"), (9, "new sample " * 20, "c")]


def deliver(spark, rows, folder):
    spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(str(folder))


def test_intake_takes_only_what_is_new(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    deliver(spark, FIRST, landing)
    assert patch_intake.run(spark, str(landing), out) == {"batches": 1, "patches": 7, "samples": 4}
    check(spark, out, FIRST)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "out/samples/sample_id=7").glob("*.parquet")}
    before = rows_of(patch_intake.output(spark, out))
    assert patch_intake.run(spark, str(landing), out) == {"batches": 0, "patches": 0, "samples": 0}
    assert rows_of(patch_intake.output(spark, out)) == before
    deliver(spark, SECOND, landing)
    assert patch_intake.run(spark, str(landing), out)["patches"] == 3
    last = {(s or None, i): (i, t, s) for i, t, s in FIRST + SECOND}
    check(spark, out, list(last.values()))
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "out/samples/sample_id=7").glob("*.parquet")} == untouched
    # all at once comes to the same
    patch_intake.run(spark, str(landing), str(tmp_path / "other"), settings("patch_intake", files_per_batch=1))
    assert rows_of(patch_intake.output(spark, str(tmp_path / "other"))) == rows_of(patch_intake.output(spark, out))


@pytest.mark.parametrize("step", ["patches", "samples", "end"])
def test_intake_survives_a_failure_at_any_step(spark, tmp_path, monkeypatch, step):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    deliver(spark, FIRST, landing)
    patch_intake.run(spark, str(landing), out)
    deliver(spark, SECOND, landing)
    with monkeypatch.context() as m:
        whole = patch_intake.sinks.samples

        def broken(*a):
            if step == "end":
                whole(*a)
            raise OSError("the cluster went away")

        if step == "patches":
            m.setattr(patch_intake.intensity, "patch_summary", broken)
        else:
            m.setattr(patch_intake.sinks, "samples", broken)
        with pytest.raises(Exception, match="went away"):
            patch_intake.run(spark, str(landing), out)
    assert patch_intake.run(spark, str(landing), out)["patches"] == 3
    check(spark, out, list({(s or None, i): (i, t, s) for i, t, s in FIRST + SECOND}.values()))
    assert spark.read.parquet(f"{out}/patches").count() == len(FIRST) + len(SECOND)


def test_intake_of_copies_of_the_tables_in_two_parts(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for part in (0, 1):
        docs.where(F.col("doc_id") % 2 == part).write.mode("append").parquet(str(tmp_path / "landing"))
        patch_intake.run(spark, str(tmp_path / "landing"), str(tmp_path / "out"))
    patch_intake.run(spark, f"{DATA}/documents.parquet", str(tmp_path / "once"))
    assert rows_of(patch_intake.output(spark, str(tmp_path / "out"))) == rows_of(patch_intake.output(spark, str(tmp_path / "once")))


def test_level_counts_of_long_and_odd_patches(spark, monkeypatch):
    monkeypatch.setattr(intensity, "SLICE", 7)
    rows = [(1, bytes(range(256)) * 3), (2, b""), (3, None), (4, b"\x00\xff" * 50)]
    got = {r.i: r for r in intensity.patch_summary(intensity.level_counts(spark.createDataFrame(rows, "i int, pixels binary"), ["i"])).collect()}
    assert got[1].levels == list(range(256)) and set(got[1].counts) == {3} and got[1].mask_area == 3 * 189 and got[1].mask_mean == 125.0
    assert (got[2].status, got[2].n_pixels, got[3].status, got[3].levels) == ("skipped_small_mask", 0, "error", None)
    assert got[4].levels == [0, 255] and got[4].mask_mean is None
    assert intensity.level_counts(spark.createDataFrame([], "i int, pixels binary"), ["i"]).count() == 0


# ------------------------------------------------------------ release

ROWS = "l_suppkey string, l_returnflag string, l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_linestatus string, l_discount double"


def test_release_names_the_sample_that_drifts_and_reruns_agree(spark, tmp_path):
    rows = [(f"s{s}", "N", i, 1, float(i % 10 + s % 3) + (50 if s == 4 else 0), float(i), "F", 0.5) for s in range(9) for i in range(40)]
    rows += [("s1", "R", 99, 1, 1e9, 1e9, "F", 1e9), (None, "N", 1, 3, 5.0, None, "O", None), ("bad", "R", 1, 1, 1.0, 1.0, "F", 1.0)]
    spark.createDataFrame(rows, ROWS).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    done = cohort_release.run(spark, str(tmp_path / "in"), out)
    before = rows_of(cohort_release.output(spark, out))
    assert cohort_release.run(spark, str(tmp_path / "in"), out) == done and rows_of(cohort_release.output(spark, out)) == before
    got = cohort_release.output(spark, out).collect()
    assert len(got) == len(rows) == done["rows"] and {r.sample_id for r in got if "morph_quantity" in r.drifted} == {"s4"}
    scaled = [r.morph_quantity for r in got if r.sample_id == "s4"]
    assert min(scaled) == 0.0 and max(scaled) == 1.0
    (bad,) = [r for r in got if r.patch_idx == 99]
    assert bad.morph_quantity is None and bad.status == "error"
    (none,) = [r for r in got if r.sample_id is None]
    assert none.patch_original_price == 0.0 and none.patch_original_price_n == 0
    # samples that are delivered alone leave the features of others
    spark.createDataFrame([r for r in rows if r[0] == "s2"], ROWS).write.parquet(str(tmp_path / "some"))
    cohort_release.run(spark, str(tmp_path / "some"), out)
    assert spark.read.parquet(f"{out}/features").count() == len(rows) and spark.read.parquet(f"{out}/report").select("sample_id").distinct().count() == 1


def test_release_of_many_samples_makes_few_folders_and_keeps_the_neighbours(spark, tmp_path):
    rows = [(f"s{s}", "R" if s == 7 else "N", i, 1, float(i + s % 5), float(i), "F", 0.5) for s in range(900) for i in range(3)] + [(None, "N", 1, 1, 2.0, 3.0, "F", 0.5)]
    spark.createDataFrame(rows, ROWS).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):
        assert cohort_release.run(spark, str(tmp_path / "in"), out)["rows"] == len(rows)
        folders = [f for f in (tmp_path / "out/features").iterdir() if f.is_dir()]
        assert len(folders) <= 256 and sum(len(list(f.glob("*.parquet"))) for f in folders) <= 2 * 256
    before = {(r.sample_id, r.patch_idx): r for r in spark.read.parquet(f"{out}/features").collect()}
    assert len(before) == len(rows)
    # every third sample again, with one row less and other values: the others stay as they are, whatever they share a folder with
    some = [(*r[:4], -r[4], *r[5:]) for r in rows if r[0] and int(r[0][1:]) % 3 == 0 and r[2] != 2]
    spark.createDataFrame(some, ROWS).write.parquet(str(tmp_path / "some"))
    cohort_release.run(spark, str(tmp_path / "some"), out)
    after = {(r.sample_id, r.patch_idx): r for r in spark.read.parquet(f"{out}/features").collect()}
    again = lambda k: k[0] is not None and int(k[0][1:]) % 3 == 0
    assert {k: r for k, r in after.items() if not again(k)} == {k: r for k, r in before.items() if not again(k)}
    assert {k for k in after if again(k)} == {(r[0], r[2]) for r in some} and spark.read.parquet(f"{out}/features").count() == len(after)


def test_release_of_nothing(spark, tmp_path):
    spark.createDataFrame([], ROWS).write.parquet(str(tmp_path / "in"))
    assert cohort_release.run(spark, str(tmp_path / "in"), str(tmp_path / "out")) == {"rows": 0, "samples": 0, "drifts": 0}


# ------------------------------------------------------------ registered queries and command lines


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_job_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    want = con.sql(f"SELECT {names} FROM ({registry.oracle_sql()[name]})").fetchall()
    nine = lambda rows: sorted(str([float(f"{v:.9g}") if isinstance(v, float) else v for v in r]) for r in rows)
    assert nine(df.select(columns).collect()) == nine(want)
    assert before == {k: spark.conf.get(k) for k in before}


def test_settings_that_are_unknown_are_an_error(tmp_path):
    (tmp_path / "own.json").write_text(json.dumps({"drift": 5}))
    assert settings("cohort_release", str(tmp_path / "own.json"))["drift"] == 5
    with pytest.raises(KeyError):
        settings("cohort_release", nothing=1)


def test_command_line(spark, tmp_path):
    spark.createDataFrame(FIRST, DOCS).write.parquet(str(tmp_path / "in"))
    env = os.environ | {"PYTHONPATH": str(ROOT)}
    for _ in range(2):
        done = subprocess.run([sys.executable, "-m", "jobs.patch_intake", str(tmp_path / "in"), str(tmp_path / "out")], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
    assert "took 0 new patches" in done.stderr
    check(spark, str(tmp_path / "out"), FIRST)
