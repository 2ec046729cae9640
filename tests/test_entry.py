"""The driver's three functions, the stream, and that the core does not need the llm folder."""

import ast
from pathlib import Path

import __spark_entry__ as entry
from claimloom.streaming.claims import stream_citations

ROOT = Path(__file__).resolve().parents[1]


def test_names_match():
    known, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(known) and {f"p{n}_found" for n in (3, 4, 5)} <= set(known)


def test_core_does_not_import_llm():
    for f in (ROOT / "claimloom").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT / "claimloom").parts:
            for node in ast.walk(ast.parse(f.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("claimloom.llm" in n for n in names), f


def test_entry(spark):
    if not Path(entry.DATA).exists():
        return
    assert entry.entry(spark).limit(5).count() >= 0


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("It rose (Smith, 2020). Lee (2019) agrees.")
    q = stream_citations(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("cits").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.citation_author for r in spark.sql("SELECT * FROM cits").collect()) == ["Lee", "Smith"]
