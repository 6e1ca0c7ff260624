"""CSV files with differing headers, tags and per-file profile."""

import os

from slicewarden.functions.suites import CSV_REQUIRED_COLUMNS
from slicewarden.operators import profile
from slicewarden.sources.csv_source import file_headers, read_csv_groups

TYPES = {"order_id": "bigint", "amount": "double", "views": "double", "source": "string"}


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def make_feed(root):
    d = os.path.join(root, "ingest_dt=2024-01-02")
    os.makedirs(d)
    write(os.path.join(d, "a.csv"), "order_id,amount,views,source\n1,10,5,Google\n2,-1,5,Google\n2,3,20000,Yahoo\n")
    # columns in another order, one junk number
    write(os.path.join(d, "b.csv"), "source,views,order_id,amount\nApple,1,3,abc\nAmazon,2,,7\n")
    # views column absent: values must not shift
    write(os.path.join(d, "c.csv"), "\ufefforder_id,amount,source,extra\r\n4,5,Apple,x\r\n4,6,Apple,y\r\n")
    write(os.path.join(d, "notes.txt"), "ignored\n")
    os.makedirs(os.path.join(root, "ingest_dt=2024-01-01"))
    write(os.path.join(root, "ingest_dt=2024-01-01", "old.csv"), "order_id,amount,views,source\n9,1,1,Apple\n")
    return d


def test_header_groups_and_missing_columns(spark, tmpdir_path):
    d = make_feed(tmpdir_path)
    assert file_headers(spark, d).count() == 3
    df = read_csv_groups(spark, d, CSV_REQUIRED_COLUMNS, TYPES)
    rows = {(os.path.basename(r._file), r.order_id, r.amount): r for r in df.collect()}
    c = rows[("c.csv", 4, 5.0)]
    assert c.views is None and c._missing == ["views"] and c.source == "Apple"
    b = rows[("b.csv", 3, None)]          # 'abc' does not parse → NULL
    assert b.views == 1.0 and b.source == "Apple" and b._missing == []


def test_tags_summary_and_sample(spark, tmpdir_path):
    d = make_feed(tmpdir_path)
    tagged = profile.tag_rows(read_csv_groups(spark, d, CSV_REQUIRED_COLUMNS, TYPES))
    tags = {(os.path.basename(r._file), r.order_id, r.amount): r._failed_rules for r in tagged.collect()}
    assert tags[("a.csv", 1, 10.0)] == ""
    assert tags[("a.csv", 2, -1.0)] == "range:amount,uniq:order_id"
    assert tags[("a.csv", 2, 3.0)] == "range:views,isin:source,uniq:order_id"
    assert tags[("b.csv", 3, None)] == "range:amount"
    assert tags[("b.csv", None, 7.0)] == "nn:order_id"
    assert tags[("c.csv", 4, 5.0)] == "missing:views,uniq:order_id"
    summ = {os.path.basename(r._file): (r.rows_total, r.rows_bad, r.sampled_bad)
            for r in profile.file_summary(tagged, cap=1).collect()}
    assert summ == {"a.csv": (3, 2, 1), "b.csv": (2, 2, 1), "c.csv": (2, 2, 1)}
    sample = profile.bad_sample(tagged, ["_block", "_pos"], cap=1).collect()
    assert len(sample) == 3
    assert {(os.path.basename(r._file), r.order_id) for r in sample} == {("a.csv", 2), ("b.csv", 3), ("c.csv", 4)}


def test_latest_partition(spark, tmpdir_path):
    from slicewarden.sources.csv_source import latest_ingest_partition
    make_feed(tmpdir_path)
    assert latest_ingest_partition(spark, tmpdir_path).endswith("ingest_dt=2024-01-02/")
