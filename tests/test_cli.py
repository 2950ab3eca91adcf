"""Command line entry points."""

import tempfile

from conftest import SMALL


def test_list_and_query(spark, capsys):
    from starloom.__main__ import main
    assert main(["list"]) == 0
    assert "star_sales" in capsys.readouterr().out.split()
    out = tempfile.mkdtemp(prefix="starloom-cli-") + "/q"
    assert main(["query", "--sf-dir", SMALL, "--out", out, "top_shipper"]) == 0
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0].total_orders > 0
    assert main(["query", "--sf-dir", SMALL, "--out", out + "x", "no_such_key"]) == 2


def test_query_on_role_tables(spark):
    from starloom.__main__ import main
    from starloom.sources.roles import export_roles
    from starloom.sources.tables import Warehouse
    roles = tempfile.mkdtemp(prefix="starloom-cli-roles-")
    export_roles(Warehouse(spark, SMALL), roles, ["orders", "shippers"])
    out = tempfile.mkdtemp(prefix="starloom-cli-") + "/q"
    assert main(["query", "--roles", "--sf-dir", roles, "--out", out, "top_shipper"]) == 0
    assert spark.read.parquet(out).count() == 1
