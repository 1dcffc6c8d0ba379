"""A report reads what it sums up once."""

from __future__ import annotations

from concordat.plans import scan_diff


def test_report_reads_its_directories_once(spark):
    """All sections of a report come from one reading of the classified directories."""
    read = spark.sparkContext.accumulator(0)
    rows = [("npm", f"d{i}", i, "n", "1", "MIT", "MIT", 2, 1, True, None, ("ACK", "NO-DETECTION", "UNACCOUNTED")[i % 3]) for i in range(90)]
    columns = "bucket string, top string, first_ord long, name string, version string, declared string, detected string, " \
        "n_files long, n_with_license long, license_file_seen boolean, rationale string, outcome string"

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    classified = spark.createDataFrame(rows, columns).mapInPandas(counted, columns)
    lines = scan_diff.report(classified).collect()
    assert read.value == 90 and sum(r.section == 4 for r in lines) == 31 and {r.line for r in lines if r.section == 1} >= {"- ACK: 30", "- UNACCOUNTED: 30"}
