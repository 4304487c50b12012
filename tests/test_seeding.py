from aerolith.operators.seeding import seed
from aerolith.sources.landing import source_table, texts


def test_five_passes(spark):
    kind = "manufacturer string, model string, variant string, cruise_speed string, max_speed string, description string, category string, translations map<string,string>"
    target = spark.createDataFrame([("Cessna", "172", None, None, None, None, "LSA", None), ("Piper", "PA-28", "", "120", None, "own", "SEP", {"de": "eigen"})], kind)
    seeds = spark.createDataFrame([("Cessna", "172", ""), ("Robin", "DR400", None), ("Robin", "DR400", "")], "manufacturer string, model string, variant string")
    keyed = lambda rows, more: spark.createDataFrame(rows, f"manufacturer string, model string, variant string, {more}")
    got = seed(
        target, seeds, keyed([("Cessna", "172", "", "110", "140"), ("Piper", "PA-28", "", "1", "2")], "cruise_speed string, max_speed string"), keyed([("Robin", "DR400", "", "text"), ("Piper", "PA-28", "", "other")], "description string"),
        keyed([("Cessna", "172", "", "SEP"), ("Piper", "PA-28", "", "Jet")], "category string"), keyed([("Piper", "PA-28", "", {"de": "x"}), ("Robin", "DR400", "", {"de": "y"})], "translations map<string,string>"), ["cruise_speed", "max_speed"], "LSA",
    )
    rows = {r.model: tuple(r)[3:] for r in got.collect()}
    assert rows == {"172": ("110", "140", None, "SEP", None), "PA-28": ("120", None, "own", "SEP", {"de": "eigen"}), "DR400": (None, None, "text", None, {"de": "y"})}


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<p>ü</p>".encode("latin-1"))
    (tmp_path / "empty.html").write_bytes(b"")
    got = {r.page_url.rpartition("/")[2]: r.payload for r in texts(spark, str(tmp_path), "iso-8859-1").collect()}
    assert got == {"a.html": "<p>ü</p>"}  # Spark passes over empty files
    assert source_table(spark).select("source").distinct().count() == 14  # the registry has all sources, not only those with a priority of their own
