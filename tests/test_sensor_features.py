"""ARFF feature files: per-file header, comments, wrong-width rows."""

import os

from pulsegrid.operators.datasets import feature_statistics
from pulsegrid.session import local_path
from pulsegrid.sources.sensor import read_sensor_features, read_sensor_raw

ARFF = """@relation person_activities
% a comment line
@attribute "ACTIVITY" {{A,B,C}}
@attribute "X0" numeric
@attribute "X1" numeric
@attribute "class" {{1600,1601}}

@data
A,0.1,0.2,{s}
% comment inside data
B,0.3,0.4,{s}

C,0.5,{s}
C,0.5,0.6,{s},extra
Z,0.7,0.8,{s}
"""


def test_read_features(spark, tmpdir_fresh):
    root = local_path(tmpdir_fresh)
    os.makedirs(root)
    for s, dev in ((1600, "phone"), (1601, "phone"), (1601, "watch")):
        with open(os.path.join(root, f"data_{s}_accel_{dev}.arff"), "w") as f:
            f.write(ARFF.format(s=s))
    df = read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone")
    rows = sorted((r.ACTIVITY, r.X0, r.X1, r["class"], r.activity_name) for r in df.collect())
    assert df.columns[:4] == ["ACTIVITY", "X0", "X1", "class"]
    assert rows == [("A", "0.1", "0.2", "1600", "walking"), ("A", "0.1", "0.2", "1601", "walking"),
                    ("B", "0.3", "0.4", "1600", "jogging"), ("B", "0.3", "0.4", "1601", "jogging"),
                    ("Z", "0.7", "0.8", "1600", None), ("Z", "0.7", "0.8", "1601", None)]
    st = feature_statistics(df).collect()[0]
    assert (st.total_samples, st.unique_subjects, st.unique_activities) == (6, 2, 3)


def test_header_join_without_broadcast_gives_the_same_rows(spark, tmpdir_fresh):
    """Headers carry no broadcast hint (sizes seen at run time decide); the rows
    of a shuffle join are the same."""
    root = local_path(tmpdir_fresh)
    os.makedirs(root)
    for s in (1600, 1601):
        with open(os.path.join(root, f"data_{s}_accel_phone.arff"), "w") as f:
            f.write(ARFF.format(s=s))
    small = sorted(map(tuple, read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone").collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone")
        rows = sorted(map(tuple, big.collect()))
        assert "Broadcast" not in big._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert small == rows and rows


def _files(root, texts):
    os.makedirs(root, exist_ok=True)
    for name, text in texts.items():
        with open(os.path.join(root, f"data_{name}_accel_phone.arff"), "w") as f:
            f.write(text)


def _brute(texts):
    """Rows of each file as {name: cell}, by reading it line by line."""
    out = []
    for name, text in texts.items():
        names, data = [], False
        for line in text.split("\n"):
            t = line.strip()
            if data:
                if t and not line.startswith("%") and len(t.split(",")) == len(names):
                    out.append((f"data_{name}_accel_phone.arff", dict(zip(names, t.split(",")))))
            elif t == "@data":
                data = bool(names)
                if not names:
                    break
            elif t.startswith("@attribute"):
                names.append(t.split()[1].strip('"'))
    return out


TEXTS = {
    "1": '@relation r\n@attribute "ACTIVITY" {A}\n@attribute "X0" numeric\n@data\nA,1\nB,2\nB,2,3\n%x\n\n C,4 \n',
    "2": '@attribute "ACTIVITY" {A}\n@attribute "X0" numeric\n@data\nA,5\n',
    "3": '@attribute "Y" numeric\n@attribute "ACTIVITY" {A}\n@attribute "Z" numeric\n@data\n7,A,8\n,,\n',
    "4": '@attribute "ACTIVITY" {A}\n@attribute "X0" numeric\nA,0\n@data\nA,6\n',  # a row before @data
    "5": '@attribute "ACTIVITY" {A}\n@attribute "X0" numeric\n@data\n@a,9\n@attribute "late" numeric\nB,10\n',  # marks after it
    "6": '@attribute "ACTIVITY" {A}\nA\n',  # no @data
    "7": "@data\nA,1\n",  # nothing declared
    "8 [x]": '@attribute "ACTIVITY" {A}\n@attribute "X0" numeric\n@data\n"A",11\n',
    "9": "",
}


def test_headers_of_all_kinds(spark, tmpdir_fresh):
    _files(local_path(tmpdir_fresh), TEXTS)
    df = read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone")
    assert df.columns == ["ACTIVITY", "X0", "Y", "Z", "source_file", "sensor_type", "device_type", "activity_name"]
    from urllib.parse import unquote
    got = sorted((unquote(r.source_file), str({c: r[c] for c in ("ACTIVITY", "X0", "Y", "Z") if r[c] is not None})) for r in df.collect())
    want = sorted((f, str({c: row[c] for c in ("ACTIVITY", "X0", "Y", "Z") if c in row})) for f, row in _brute(TEXTS))
    assert got == want and len(want) == 10
    some = read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone", columns=["Z", "ACTIVITY"])
    assert some.columns[:2] == ["Z", "ACTIVITY"] and some.count() == len(want)


def test_no_line_is_shuffled_or_joined(spark, tmpdir_fresh):
    _files(local_path(tmpdir_fresh), {k: TEXTS[k] for k in ("1", "2", "3")})
    df = read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "map_from_arrays" not in plan
    assert plan.count("FileScan text") == 2  # one for each distinct header


def test_no_feature_files(spark, tmpdir_fresh):
    _files(local_path(tmpdir_fresh), {k: TEXTS[k] for k in ("6", "7", "9")})
    assert read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone").count() == 0
    assert read_sensor_features(spark, tmpdir_fresh, "accelerometer", "phone", columns=["ACTIVITY"]).columns[0] == "ACTIVITY"


def test_sensor_files_are_listed_in_a_few_tasks(spark, tmpdir_fresh):
    most, track = 4 * spark.sparkContext.defaultParallelism, spark.sparkContext.statusTracker()
    for i in range(100):
        folder = os.path.join(local_path(tmpdir_fresh), f"file=data_{i}_accel_phone.txt")
        os.makedirs(folder)
        with open(os.path.join(folder, "part-0.txt"), "w") as f:
            f.write("1600,A,1,0.5,0.25,0.125;\n")
    spark.sparkContext.setJobGroup("sensor listing", "sensor listing")
    try:
        raw = read_sensor_raw(spark, tmpdir_fresh, "accelerometer", "phone", glob="part-*")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tasks = [track.getStageInfo(s).numTasks for j in track.getJobIdsForGroup("sensor listing") for s in track.getJobInfo(j).stageIds]
    assert most < 100 and tasks and max(tasks) <= most
    assert raw.count() == 100 == raw.select("source_file").distinct().count()
