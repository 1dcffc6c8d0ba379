"""Small tables of lookups do not make all components move, and planned components are not planned again."""

from __future__ import annotations

import json

from concordat.bindings import jobs
from concordat.plans import enrichment
from concordat.session import pin
from concordat.sources import inventory
from tests.test_enrichment import COMPONENTS, ISC, MIT, crate, key, tar


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _flat(spark, folder):
    (folder / "a.json").write_text(json.dumps({"bomFormat": "CycloneDX", "components": COMPONENTS}))
    return pin(inventory.flatten(inventory.read_components(spark, str(folder / "a.json"))))


def test_tools_are_met_without_a_shuffle(spark, tmp_path):
    assert "hashpartitioning" not in _plan(enrichment.plan_sources(_flat(spark, tmp_path), jobs.no_tools(spark)))


def test_planned_components_are_taken_as_they_are(spark, tmp_path):
    """Also with an id that has two canonical texts: its components have a row for each, as ever."""
    flat, tools = _flat(spark, tmp_path), jobs.no_tools(spark)
    curation = spark.createDataFrame([], "key string, rationale string")
    landed = spark.createDataFrame([(key(crate("matched")), bytearray(tar({"matched-1/LICENSE": MIT})))], "key string, content binary")
    texts = spark.createDataFrame([("ISC", ISC), ("ISC", ISC + "again"), ("Zlib", ISC)], "id string, text string")
    planned = pin(enrichment.plan_sources(flat, tools))
    got = [sorted(map(tuple, enrichment.enrich(c, tools, curation, landed, texts).results.select("name", "status", "source_tag", "reason").collect()))
           for c in (planned, flat)]
    assert got[0] == got[1]
    assert ("matched", "enriched", "matched", "") in got[0]
    assert [r[0] for r in got[0]].count("gone") == 2
