"""Staged publish, manifest, verification and tampering."""

import inspect
import os

import pytest

from slicewarden.plans import jobs
from slicewarden.sources import files, publish


def good_rows(spark, n=50):
    return spark.range(n).selectExpr("id AS order_id", "id * 1.5 AS amount").repartition(3)


def test_round_trip_and_tamper(spark, tmpdir_path):
    final = os.path.join(tmpdir_path, "ready", "date=2024-01-15")
    out = publish.publish_partition(spark, good_rows(spark), final_prefix=final, run_date="2024-01-15",
                                    run_id="r1", mode="basic", success=True, export_good_on_failure=True)
    assert out.published and out.action == "publish" and out.staged_files == 3
    assert files.exists(spark, final + "/_SUCCESS") and files.exists(spark, final + "/_MANIFEST.json")
    m = publish.load_manifest(spark, final)
    assert m["file_count"] == 3 and m["run"]["validation_success"] is True
    uris = publish.published_files(spark, final)
    assert uris == sorted(uris, key=lambda u: u.rsplit("/", 1)[-1]) and len(uris) == 3
    assert publish.read_published(spark, final).count() == 50
    # staged files are invisible to readers of the table root
    assert spark.read.parquet(os.path.join(tmpdir_path, "ready")).count() == 50

    # already published, republish not allowed → kept
    again = publish.publish_partition(spark, good_rows(spark, 10), final_prefix=final, run_date="2024-01-15",
                                      run_id="r2", mode="basic", success=True, export_good_on_failure=True)
    assert again.action == "skip_already_published" and publish.read_published(spark, final).count() == 50

    # tamper: append bytes to one file, delete another
    victims = [u.replace("file:", "") for u in uris]
    with open(victims[0], "ab") as f:
        f.write(b"xx")
    # the local filesystem's checksum sidecar would catch this itself
    crc = os.path.join(os.path.dirname(victims[0]), "." + os.path.basename(victims[0]) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    os.remove(victims[1])
    with pytest.raises(ValueError):
        publish.published_files(spark, final, strict=True)
    loose = publish.verify_manifest(spark, m, final, strict=False).collect()
    assert {r.status for r in loose} == {"size_mismatch", "ok"} and len(loose) == 2


def test_failed_marker_and_unpublished(spark, tmpdir_path):
    final = os.path.join(tmpdir_path, "date=2024-01-16")
    out = publish.publish_partition(spark, good_rows(spark), final_prefix=final, run_date="2024-01-16",
                                    run_id="r9", mode="cross", success=False, export_good_on_failure=False)
    assert out.action == "mark_failed" and not out.published
    assert files.exists(spark, final + "/_staging/r9/_FAILED")
    with pytest.raises(RuntimeError):
        publish.published_files(spark, final)


def test_partial_publish_and_dry_run(spark, tmpdir_path):
    final = os.path.join(tmpdir_path, "date=2024-01-17")
    dry = publish.publish_partition(spark, good_rows(spark), final_prefix=final, run_date="2024-01-17",
                                    run_id="d", mode="basic", success=False, export_good_on_failure=True,
                                    dry_run=True)
    assert dry.action == "dry_run" and not os.path.exists(final)
    out = publish.publish_partition(spark, good_rows(spark), final_prefix=final, run_date="2024-01-17",
                                    run_id="p", mode="basic", success=False, export_good_on_failure=True,
                                    max_records_per_file=10)
    assert out.published and out.manifest["run"]["partial_publish"] is True
    assert out.manifest["file_count"] == out.staged_files >= 5


def test_same_size_content_tamper_is_a_checksum_mismatch(spark, tmpdir_path):
    final = os.path.join(tmpdir_path, "date=2024-02-01")
    out = publish.publish_partition(spark, good_rows(spark), final_prefix=final, run_date="2024-02-01",
                                    run_id="c1", mode="basic", success=True, export_good_on_failure=True,
                                    checksums=True)
    m = out.manifest
    victim = m["files"][0]["uri"].replace("file:", "")
    with open(victim, "r+b") as f:          # flip one byte in the middle, size unchanged
        f.seek(os.path.getsize(victim) // 2)
        b = f.read(1)
        f.seek(-1, 1)
        f.write(bytes([b[0] ^ 0xFF]))
    crc = os.path.join(os.path.dirname(victim), "." + os.path.basename(victim) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    st = {r.uri: r.status for r in publish.verify_manifest(spark, m, final, strict=False).collect()}
    assert st[m["files"][0]["uri"]] == "checksum_mismatch"
    assert sorted(set(st.values())) == ["checksum_mismatch", "ok"]


def test_same_size_rewrite_is_seen_by_default(spark, tmpdir_path):
    final = os.path.join(tmpdir_path, "date=2024-02-02")
    out = publish.publish_partition(spark, good_rows(spark), final_prefix=final, run_date="2024-02-02",
                                    run_id="c2", mode="basic", success=True, export_good_on_failure=True)
    m = out.manifest
    assert {r.status for r in publish.verify_manifest(spark, m, final, strict=False).collect()} == {"ok"}
    victim = m["files"][0]["uri"].replace("file:", "")
    with open(victim, "r+b") as f:
        f.seek(os.path.getsize(victim) // 2)
        b = f.read(1)
        f.seek(-1, 1)
        f.write(bytes([b[0] ^ 0xFF]))
    st = {r.uri: r.status for r in publish.verify_manifest(spark, m, final, strict=False).collect()}
    assert st.pop(m["files"][0]["uri"]) == "modified" and set(st.values()) <= {"ok"}
    with pytest.raises(ValueError, match="modified"):
        publish.read_published(spark, final)
    assert inspect.signature(jobs.validate_day).parameters["checksums"].default is False
