import json

from eventweave.__main__ import main
from eventweave.sources import fixtures


def test_from_cached_pages_to_an_answer(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "January_2022.html").write_text(fixtures.PORTAL)
    at = lambda x: f"file://{tmp_path}/{x}"
    assert main(["extract", at("pages"), at("m"), "-s", "2022-01", "-e", "2022-02"], spark) == 0
    assert main(["extract", at("pages"), at("m"), "-s", "2022-01", "-e", "2022-02", "--force", "--first-day", "2022-01-01", "--last-day", "2022-01-31"], spark) == 0
    assert main(["load", at("m"), at("store")], spark) == 0
    assert main(["turtle", at("m"), at("ttl")], spark) == 0
    capsys.readouterr()
    assert main(["list", at("store")], spark) == 0
    assert capsys.readouterr().out.split() == ["January_2022"]
    assert main(["query", at("store"), "SELECT (COUNT(*) AS ?n) WHERE { ?e a NewsSummary }", "--from", "January_2022"], spark) == 0
    assert json.loads(capsys.readouterr().out)["n"] == 4
    assert main(["drop", at("store"), "January_2022"], spark) == 0 and main(["drop", at("store"), "May_2000"], spark) == 1
    assert main(["merge", at("m"), "--name", "Whole_0000"], spark) == 0


def test_a_bad_month_is_listed_and_the_others_are_built(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "January_2022.html").write_text(fixtures.PORTAL)
    (tmp_path / "pages" / "February_2022.html").write_text('<div id="2022_February_3"><p>no box</p></div>')
    at = lambda x: f"file://{tmp_path}/{x}"
    run = ["extract", at("pages"), at("m"), "-s", "2022-01", "-e", "2022-03"]
    assert main(run, spark) == 1
    assert "February_2022: ValueError" in capsys.readouterr().err
    status = {r.month: (r.status, r.events > 0) for r in spark.read.json(at("m/_status")).collect()}
    assert status == {"January_2022": ("published", True), "February_2022": ("failed", False)}
    from eventweave.sources import modules

    assert modules.exists(spark, at("m"), "January_2022") and not modules.exists(spark, at("m"), "February_2022")
    # mended, it is tried again, and the month that is there is left alone
    (tmp_path / "pages" / "February_2022.html").write_text("<html></html>")
    assert main(run, spark) == 0
    assert [r.month for r in spark.read.json(at("m/_status")).collect()] == ["February_2022"]
