import os
import time

from churnlake.streaming.landing import land, landed_rows, watch_files


def drop(folder, name, text, modified):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as file:
        file.write(text)
    os.utime(path, (modified, modified))


def run(spark, tmp_path):
    files = watch_files(
        spark, f"{tmp_path}/drop", "Offers*.csv", "csv", "a string, b string", header=True
    )
    query = land(files, f"{tmp_path}/bronze", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    return landed_rows(spark, f"{tmp_path}/bronze")


def test_files_land_once_and_newer_ones_replace(spark, tmp_path):
    now = time.time()
    drop(f"{tmp_path}/drop", "Offers.csv", "a,b\n1,x\n2,y\n", now - 500)
    drop(f"{tmp_path}/drop/deep/er", "Offers2.csv", "a,b\n3,z\n", now - 400)
    drop(f"{tmp_path}/drop", "Usage.csv", "a,b\n9,n\n", now - 400)
    landed = run(spark, tmp_path)
    assert sorted((row.a, row.b) for row in landed.collect()) == [("1", "x"), ("2", "y"), ("3", "z")]
    # A second run without new files lands nothing.
    assert run(spark, tmp_path).count() == 3
    # The same name dropped later in another folder takes the place of the first.
    drop(f"{tmp_path}/drop/later", "Offers.csv", "a,b\n1,new\n", now - 100)
    landed = run(spark, tmp_path)
    assert sorted((row.a, row.b) for row in landed.collect()) == [("1", "new"), ("3", "z")]
    # Of two files of one name and time the last path counts.
    drop(f"{tmp_path}/drop/m", "Offers3.csv", "a,b\n7,first\n", now - 50)
    drop(f"{tmp_path}/drop/z", "Offers3.csv", "a,b\n7,last\n", now - 50)
    landed = run(spark, tmp_path)
    assert sorted((row.a, row.b) for row in landed.collect()) == [
        ("1", "new"), ("3", "z"), ("7", "last")
    ]
    # The dropped files are still there.
    assert os.path.exists(f"{tmp_path}/drop/Offers.csv")


def test_micro_batches_are_limited(spark, tmp_path):
    for number in range(5):
        drop(f"{tmp_path}/drop", f"Offers{number}.csv", f"a,b\n{number},x\n", time.time() - 100)
    files = watch_files(
        spark, f"{tmp_path}/drop", "*.csv", "csv", "a string, b string", max_files=2, header=True
    )
    query = land(files, f"{tmp_path}/bronze", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    batches = [progress["numInputRows"] for progress in query.recentProgress]
    assert sum(batches) == 5
    assert max(batches) == 2
