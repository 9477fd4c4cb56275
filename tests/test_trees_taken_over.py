"""Local trees whose folders are taken over by the next part, and listings of many folders."""

import os

from pyspark.sql import functions as F

from vocalake.sources import listing, sidecars
from vocalake.sources.listing import artifact_files, list_tree


def _table(spark, rows):
    return spark.createDataFrame(rows, "name string, payload string")


def _tree(top):
    return {os.path.relpath(os.path.join(d, f), top): open(os.path.join(d, f)).read() for d, _, names in os.walk(top) for f in names}


def _inodes(top):
    return {os.stat(os.path.join(d, x)).st_ino for d, inner, names in os.walk(top) for x in [*inner, *names]}


def test_folders_of_a_spent_tree_are_taken_over(spark, tmp_path):
    first = [(f"run_{i // 4}/step_{i}/{n}", f"{n} of {i}" * (1 + i % 3)) for i in range(200) for n in (("config.json", "weights.bin") if i % 2 else ("state.json",))]
    then = [(f"x_{i // 4}/step_{i}/{n}", "" if i % 5 == 0 else f"new {i}") for i in range(180) for n in (("config.json", "more.json") if i % 2 else ("state.json",))]
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    deal = F.substring_index("name", "/", 1)
    sidecars.write_tree(_table(spark, first), old, 4, deal)
    assert _tree(old) == dict(first)
    before = _inodes(old)
    sidecars.write_tree(_table(spark, [*then, (then[0][0], "a last one"), ("top.txt", "at the top")]), new, 4, deal, [old])
    assert _tree(new) == dict(then) | {then[0][0]: "a last one", "top.txt": "at the top"}  # no name, byte or file of before
    assert len(_inodes(new) & before) > 0.5 * len(_inodes(new))  # most are the files and folders of before
    assert not os.path.exists(f"{new}-staging")
    sidecars.drop_trees(spark, [old, new], 4)
    assert os.listdir(tmp_path) == []


def test_tasks_that_share_a_folder(spark, tmp_path):
    rows = [(f"a/b/f{i:03d}", str(i)) for i in range(300)] + [("a", None), ("c/d", "x")]
    sidecars.write_tree(_table(spark, rows), str(tmp_path / "t"), 4, F.col("name"))
    assert _tree(tmp_path / "t") == {n: p for n, p in rows if p is not None}


def test_a_folder_with_most_files_is_cut_and_small_ones_stay_together(spark):
    rows = [(f"big/step_{i}/config.json", str(i)) for i in range(150)] + [(f"run_{i % 50}/step_{i}/config.json", f"r{i}") for i in range(150)]
    parts = []

    def read(path):
        out = artifact_files(spark, path).where("name is not null").select("dir", "body")
        parts.append({r.dir for r in out.collect()})
        return out

    got = sidecars.by_parts_of_tree(_table(spark, rows), read, most=80)
    assert sorted((f"{r.dir}/config.json", r.body) for r in got.collect()) == sorted(rows)
    where = {}
    for k, own in enumerate(parts):
        for d in own:
            where.setdefault(d.partition("/")[0], set()).add(k)
    assert len(parts) == 4 and len(where["big"]) > 1 and all(len(v) == 1 for n, v in where.items() if n != "big")


def test_a_listing_goes_down_in_a_task_and_hands_back_the_rest(spark, tmp_path, monkeypatch):
    for i in range(80):
        os.makedirs(tmp_path / f"r{i}" / "a" / "b" / "c")
        (tmp_path / f"r{i}" / "a" / "b" / "c" / "f.json").write_text(str(i))
    want = sorted((os.path.relpath(d, tmp_path).removeprefix("."), x) for d, inner, names in os.walk(tmp_path) for x in [*inner, *names])
    dealt, stored = [], listing.stored
    monkeypatch.setattr(listing, "stored", lambda df: dealt.append(1) or stored(df))
    assert sorted((r["dir"], r["name"]) for r in list_tree(spark, str(tmp_path)).collect()) == want
    assert len(dealt) == 2  # the top, then all that is below
    monkeypatch.setattr(listing, "WALK", 20)
    assert sorted((r["dir"], r["name"]) for r in list_tree(spark, str(tmp_path)).collect()) == want
    assert len(dealt) > 4


def test_runs_come_whole_and_answer_as_the_table(spark):
    from vocalake.operators import runs

    rows = [(f"run_{i % 40}/{'latest' if i % 7 == 0 else f'step_{i:07d}'}", ("weights.safetensors", "config.json", "training_state.json", "training_state.json")[i % 4], ("", '{"base_model": "m%d"}' % i, '{"step": %d}' % i, "{}")[i % 4]) for i in range(1200)]
    table = spark.createDataFrame([*rows, *((d, n, f"{b} ") for d, n, b in rows[:300] if n != "weights.safetensors")], "dir string, name string, body string").groupBy("dir", "name").agg(F.max("body").alias("body"))
    seen = []

    def read(path):
        out = artifact_files(spark, path).where("dir <> ''")
        seen.append({r["dir"].partition("/")[0] for r in out.select("dir").distinct().collect()})
        return out

    got = sidecars.by_parts_of_tree(table.select(F.concat_ws("/", "dir", "name").alias("name"), F.col("body").alias("payload")), read, most=650)
    assert len(seen) == 2 and not seen[0] & seen[1] and len(seen[0] | seen[1]) == 40
    for f in (runs.artifact_catalog, runs.resume_point):
        own = f(got.where("dir like '%/%'"))
        assert sorted(map(tuple, own.collect()), key=repr) == sorted(map(tuple, f(table).collect()), key=repr)
