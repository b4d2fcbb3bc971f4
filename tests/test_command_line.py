import pytest
import rental
from helpers import bag

from tidewright.__main__ import _arguments, _source, main


def test_steps_from_the_command_line(spark, folder, capsys):
    def save(tables, name):
        for table, df in tables.items():
            df.coalesce(1).write.parquet(f"{folder}/{name}/{table}.parquet")

    before = rental.tables(spark)
    save(before, "before")
    save(rental.changed(before), "after")

    def run(*args):
        code = main([*args, "--root", f"{folder}/house"], spark)
        return code, capsys.readouterr().out

    assert run("full-load", "--source-folder", f"{folder}/before", "--as-of", "2024-01-01")[0] == 0
    after = ["--source-folder", f"{folder}/after"]
    _, out = run("extract-load", "2024-01-01", "2025-01-01", *after)
    assert "film_actor" in out and "payment" not in out
    assert run("transform")[0] == 0
    _, out = run("status")
    assert "film_fact" in out
    code, out = run("checks", "--as-of", "2030-01-01")
    assert code == 0 and "passed" in out
    with pytest.raises(ValueError, match="name a source"):
        run("cycle")
    _, out = run("schema")
    assert "CREATE TABLE raw.film_actor(actor_id int,film_id int,last_update timestamp_ntz);" in out
    films = spark.read.parquet(f"{folder}/house/dw/film_dim/seg-*")
    assert (41,) in bag(films, "film_id")


def test_database_options():
    args = _arguments([
        "cycle", "--root", "r", "--source-jdbc", "jdbc:x://host/shop", "--jdbc-schema", "shop",
        "--jdbc-option", "user=reader", "--jdbc-option", "sessionInitStatement=SET a=1",
        "--jdbc-split", "film=film_id,1,900,4"])
    seen = []

    class Session:
        read = property(lambda self: self)

        def format(self, name):
            return self

        def options(self, **given):
            seen.append(given)
            return self

        def load(self):
            return "frame"

    assert _source(Session(), args)("film") == "frame"
    assert {k: v for one in seen for k, v in one.items()} == {
        "url": "jdbc:x://host/shop", "dbtable": "shop.film", "preferTimestampNTZ": "true",
        "user": "reader", "sessionInitStatement": "SET a=1", "partitionColumn": "film_id",
        "lowerBound": "1", "upperBound": "900", "numPartitions": "4"}


@pytest.mark.parametrize("args", [
    ["cycle", "2024-01-01"], ["checks", "a", "b"], ["other"], ["cycle", "--jdbc-option", "x"],
    ["cycle", "--jdbc-split", "film=film_id,1,900"]])
def test_wrong_arguments(spark, folder, args):
    with pytest.raises(SystemExit):
        main([*args, "--root", folder], spark)
