"""Command line on the smallest test data: convert, report, SQL, similar, check."""

from __future__ import annotations

import os
import sys

from marketlens.cli import main

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def test_cli_round(spark, tmp_path, capsys):
    out = str(tmp_path / "wh")
    assert main(["convert-testdata", "/root/testdata/sf0.001", out]) == 0
    assert main(["report", "q1", out, "years=(1996,1997)"]) == 0
    assert "total_revenue" in capsys.readouterr().out
    assert main(["sql", out, "SELECT count(*) AS n FROM orders"]) == 0
    assert main(["similar", out]) == 0
    assert "Popular products" in capsys.readouterr().out
    assert main(["similar", out, "-1", "--top", "3"]) == 0
    assert "sample" in capsys.readouterr().out
    assert main(["explain", "q2n", out]) == 0
    assert "PushedFilters" in capsys.readouterr().out
    metrics = str(tmp_path / "formats.json")
    assert main(["formats", out, "1997", "10", "--iterations", "1", "--out", metrics]) == 0
    assert spark.read.json(metrics).count() == 9
    assert main(["schema", out]) == 0
    assert "dimensions.weight_g" in capsys.readouterr().out
    main(["check", out])
    assert "orders files use snappy" in capsys.readouterr().out


def test_cli_convert_raw_csv(spark, tmp_path, capsys):
    from marketlens.schemas import RAW_FILES
    from test_etl_fixtures import CSV

    raw = tmp_path / "raw"
    raw.mkdir()
    for key, text in CSV.items():
        (raw / RAW_FILES[key]).write_text(text)
    out = str(tmp_path / "lake")
    assert main(["convert", str(raw), out]) == 0
    text = capsys.readouterr().out
    assert "orders" in text and "year, month" in text
    assert main(["similar", out, "p1", "--top", "2"]) == 0
    assert "similar" in capsys.readouterr().out
    assert main(["check", out, "--min-rows", "orders=4", "--review-partitions", "5"]) == 0
    assert main(["check", out, "--min-rows", "orders=1000"]) == 1
