"""One rule for all functions that add columns: added ones take the place of those of their
name, all others pass through, whatever they are called."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, lines, mixing, quality, simhash, spans, toxicity, urls, winnow

TEXT = "One two three four five six. Seven eight nine ten eleven twelve."
MODULES = {m.__name__.rsplit(".", 1)[1]: m for m in (langid, lines, mixing, quality, simhash, spans, toxicity, urls, winnow)}


def names_in(module):
    """Every column name that the module's code mentions."""
    found = re.findall(r'"([A-Za-z_][A-Za-z_0-9]*)"', inspect.getsource(module))
    return sorted({n.lower() for n in found} - {"doc_id", "text", "lang", "source", "size", "url", "fetched", "quality", "toxic"})


def cases():
    language = lambda d: langid.with_language(d, langid.pickle.dumps(langid.Model([(TEXT, "en")])))
    net = lambda d: toxicity.with_score(d, toxicity.pickle.dumps(toxicity.train([TEXT, "bad words"], [0, 1], 1, least_steps=2)))
    entries = lambda d: d.sparkSession.createDataFrame([], "list string, scope string, key string, since date, until date, start date, active boolean, day date, action string")
    yield "langid", language, ["lang_pred", "score"]
    yield "lines", lines.dedup_lines, None
    yield "mixing", lambda d: mixing.mix(d), ["source_size", "target", "taken", "first_slot"]
    yield "mixing", mixing.mix_documents, []
    yield "quality", quality.with_measures, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    yield "simhash", simhash.with_fingerprint, ["bits"]
    yield "simhash", simhash.keep_one, []
    yield "spans", spans.remove_repeats, ["n_removed", "repeats_of"]
    yield "toxicity", net, ["score"]
    yield "winnow", winnow.fingerprints, ["marks"]


@pytest.mark.parametrize("case", list(cases()), ids=lambda c: c[0])
def test_any_column_name_passes_through(rows, case):
    module, add, added = case
    others = names_in(MODULES[module])
    docs = rows("doc_id long, text string, source string, lang string, size long", (1, TEXT, "s", "en", 3), (2, None, None, None, 0))
    docs = docs.select("*", *[F.lit(f"own {n}").alias(n) for n in others])
    out = add(docs)
    assert len(set(map(str.lower, out.columns))) == len(out.columns)
    new = [c for c in out.columns if c not in docs.columns] if added is None else added
    assert set(new) <= set(out.columns)
    for r in out.collect():
        for n in others:
            if n not in new and n in out.columns and added is not None:
                assert r[n] == f"own {n}"
    if added is not None:
        assert set(out.columns) == {*docs.columns, *added}


def test_urls_with_any_column_name(spark, rows):
    others = names_in(urls)
    captures = rows("url string, fetched string", ("http://a.b/c", "2024-01-05"), (None, None)).withColumn("fetched", F.col("fetched").cast("date"))
    pages = rows("page_id long, url string", *[(i, f"http://h{i}.com/x") for i in range(20)])
    wide = captures.select("*", *[F.lit(f"own {n}").alias(n) for n in others])
    out = urls.filter_urls(wide, urls.dated_lists(pages))
    added = {"blocked", "entries", "lists", "since"}
    assert set(out.columns) == {*wide.columns, *added} and len(out.columns) == len(set(out.columns))
    assert all(r[n] == f"own {n}" for r in out.collect() for n in others if n not in added)
