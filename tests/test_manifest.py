import gzip

import pytest

from linklake.sources import manifest

PATH = "crawl-data/CC-MAIN-2025-13/segments/17.{}/warc/x-{}.warc.gz"


def test_partition_format():
    assert manifest.check_partition("2025-13") == "2025-13"
    for bad in ("2025-1", "2025-133", "x", "", "2025-13\n"):
        with pytest.raises(ValueError):
            manifest.check_partition(bad)


def test_manifest(spark, tmp_path):
    lines = [PATH.format(n, n) for n in (5, 3, 4, 3, 1, 2)] + ["other", PATH.format(1, 1).replace("2025-13", "2025-08")]
    lines += ["see " + PATH.format(0, 0) + " here", PATH.format(1, 1) + ".extra"]
    (tmp_path / "warc.paths.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    read = manifest.read_manifest(spark, str(tmp_path / "warc.paths.gz"))
    assert manifest.archive_paths(read, "2025-13").count() == 6
    picks = manifest.pick_first(read, "2025-13")
    assert [r.path for r in picks.collect()] == [PATH.format(n, n) for n in (0, 1, 2)]
    kept = manifest.lines_with_prefix(read, picks)
    assert sorted(r.value for r in kept.collect()) == sorted(
        [PATH.format(1, 1), PATH.format(1, 1) + ".extra", PATH.format(2, 2)]
    )
    nested = spark.createDataFrame([(PATH.format(n, n),) for n in range(1, 6)] + [(PATH.format(1, 1)[:-3],), (None,)], "path string")
    assert manifest.lines_with_prefix(read, nested).count() == 7
    assert manifest.lines_with_prefix(read, nested.limit(0)).count() == 0
