import os
import tempfile

from tessera.streaming.landing import start_landing


def test_landing_in_batches_of_twenty(spark):
    src = tempfile.mkdtemp(prefix="tessera-land-src-")
    for i in range(25):
        with open(os.path.join(src, f"page-{i:02d}.html"), "w", encoding="utf-8") as f:
            f.write(f'<html lang="en"><head><title>P{i}</title></head><body><article><h1>H{i}</h1>'
                    f'</article></body></html>')
    out = tempfile.mkdtemp(prefix="tessera-land-out-")
    ckpt = tempfile.mkdtemp(prefix="tessera-land-ckpt-")
    q = start_landing(spark, src, out, ckpt)
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    sizes = sorted(r["count"] for r in res.groupBy("batch").count().collect())
    assert sizes == [5, 20]
    assert res.select("url_key").distinct().count() == 25
    assert res.where("title = 'P3' AND h1 = 'H3' AND url_key = 'page-03'").count() == 1


def test_last_file_of_a_key_wins(spark):
    """One key twice in a batch, and keys with a blank and a plus in their names."""
    src = tempfile.mkdtemp(prefix="tessera-land-src-")
    page = '<html lang="en"><head><title>{0}</title></head><body><article><h1>{0}</h1></article></body></html>'
    for folder, name, title, age in (("a", "x y+z", "old", 1000), ("b", "x y+z", "new", 3000), ("c", "x y+z", "older", 2000),
                                     ("a", "same", "first", 1000), ("b", "same", "last path", 1000), ("c", "alone", "alone", 5)):
        os.makedirs(os.path.join(src, folder), exist_ok=True)
        file = os.path.join(src, folder, f"{name}.html")
        with open(file, "w", encoding="utf-8") as f:
            f.write(page.format(title))
        os.utime(file, (age, age))
    out, ckpt = tempfile.mkdtemp(prefix="tessera-land-out-"), tempfile.mkdtemp(prefix="tessera-land-ckpt-")
    start_landing(spark, f"{src}/*", out, ckpt).awaitTermination(120)
    got = {r["url_key"]: r["title"] for r in spark.read.parquet(out).collect()}
    assert got == {"x y+z": "new", "same": "last path", "alone": "alone"}
    assert spark.read.parquet(out).count() == 3
