"""The command line on a Parquet source."""

from __future__ import annotations

import contextlib
import time

import pytest

from salesmart import job
from salesmart.operators import staging
from salesmart.plans.quality import ValidationError
from salesmart.sinks import lease
from salesmart.sources.tables import SOURCE_SCHEMAS, short_name


@pytest.fixture(scope="module")
def folder(edge_source, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source"))
    for table in SOURCE_SCHEMAS:
        getattr(edge_source, short_name(table)).write.parquet(f"{path}/{short_name(table)}")
    return path


def test_daily_then_dashboard(spark, folder, tmp_path, capsys):
    warehouse = str(tmp_path / "warehouse")
    job.main([
        "daily", "--source", folder, "--warehouse", warehouse,
        "--first", "2014-12-31", "--run-date", "2024-02-07"])
    printed = capsys.readouterr().out
    assert "fato_venda: 9 rows" in printed and "vendas_localidade: 4 rows" in printed
    job.main(["dashboard", "--warehouse", warehouse])
    printed = capsys.readouterr().out
    assert "▲ R$ 0.00 vs meta" in printed and "R$ 39.00  (103%)" in printed


def test_staged_tables_go_with_the_job(spark, folder, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(staging, "scratch_folder", lambda spark: str(scratch))
    for day in ("2024-02-07", "2024-03-01"):  # the second day fails validation
        with contextlib.suppress(ValidationError):
            job.main(["daily", "--source", folder, "--warehouse", str(tmp_path / day),
                      "--run-date", day])
        assert scratch.is_dir() and not list(scratch.iterdir())


@pytest.mark.parametrize("mode, kind", [("daily", "_send_days"), ("refresh", "_send_all")])
def test_facts_are_sent_where_asked(tmp_path, mode, kind):
    (tmp_path / "pw").write_text("secret")
    asked = [mode, "--source", "s", "--warehouse", "w",
             *(["--run-date", "2024-01-01"] if mode == "daily" else []),
             "--mart-jdbc", "jdbc:postgresql://h/db", "--mart-user", "u",
             "--mart-password-file", str(tmp_path / "pw")]
    parse = job._arguments().parse_args
    assert job._fact_sink(parse(asked)) is None
    sink = job._fact_sink(parse([*asked, "--fact-table", "dw.fato_venda"]))
    assert sink.func is getattr(job, kind) and sink.args[1:] == ("dw.fato_venda", 16)


@pytest.mark.parametrize("more, said", [
    (["--fact-table", "t"], "--fact-table needs --mart-jdbc"),
    (["--mart-jdbc", "jdbc:x"], "needs --mart-user and --mart-password-file"),
    (["--mart-jdbc", "jdbc:x", "--mart-user", "u"], "needs --mart-password-file"),
    (["--first", "2024-01-02"], "--first is after --run-date"),
])
def test_arguments_that_lack_others_are_refused(capsys, more, said):
    with pytest.raises(SystemExit):
        job.main(["daily", "--source", "s", "--warehouse", "w", "--run-date", "2024-01-01", *more])
    assert said in capsys.readouterr().err


def test_a_second_run_is_refused_and_a_dead_one_is_replaced(spark, folder, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    run = ["daily", "--source", folder, "--warehouse", warehouse, "--run-date", "2024-02-07"]
    owner = lease.take(spark, warehouse)
    with pytest.raises(lease.LeaseError, match=owner):
        job.main(run)
    assert not (tmp_path / "warehouse" / "dim_tempo").exists()
    lease.give_back(spark, warehouse, "another")
    with pytest.raises(lease.LeaseError):
        lease.take(spark, warehouse, now=lambda: time.time() + lease.EXPIRY - 60)
    # The holder died: its time is over.
    later = lease.take(spark, warehouse, now=lambda: time.time() + lease.EXPIRY + 60)
    lease.give_back(spark, warehouse, owner)
    with pytest.raises(lease.LeaseError, match=later):
        job.main(run)
    lease.give_back(spark, warehouse, later)
    job.main(run)
    assert [p.name for p in (tmp_path / "warehouse").iterdir() if "lease" in p.name] == []


def test_refresh(spark, folder, tmp_path, capsys):
    job.main([
        "refresh", "--source", folder, "--warehouse", str(tmp_path / "warehouse"),
        "--lake", str(tmp_path / "lake")])
    assert "vendas_ano_mes: 2 rows" in capsys.readouterr().out
    assert (tmp_path / "lake" / "base" / "ano=2024").is_dir()


def test_mart_writer_is_only_built_for_a_mart_address(tmp_path):
    (tmp_path / "pw").write_text("secret\n")
    required = ["daily", "--source", "s", "--warehouse", "w", "--run-date", "2024-01-01"]
    parse = job._arguments().parse_args
    assert job._mart_sink(parse(required)) is None
    sink = job._mart_sink(parse(required + [
        "--mart-jdbc", "jdbc:postgresql://h/db", "--mart-user", "u",
        "--mart-password-file", str(tmp_path / "pw")]))
    assert sink.args[1] == 16 and sink.args[0].password == "secret"
