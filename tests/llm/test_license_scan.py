import math
import re

import numpy as np
import pytest
from llm_helpers import number_words
from rosterline.llm import license_scan
from rosterline.llm.license_scan import TEMPLATES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(found):
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]


def brute_force(text):
    """Templates of which some span of a quarter more than their length holds the required share."""
    held, out = shingles(words(text)), set()
    for name, template in TEMPLATES.items():
        wanted = set(shingles(words(template)))
        span = math.ceil(1.25 * len(words(template))) - 4
        at = [i for i, s in enumerate(held) if s in wanted]
        if any(len({held[j] for j in at if i <= j < i + span}) >= 0.8 * len(wanted) for i in at):
            out.add(name)
    return out


def test_like_brute_force(docs):
    rng = np.random.default_rng(6)
    rows = [(1, None), (2, ""), (3, "MIT License"), (4, TEMPLATES["mit-notice"] * 3), (5, "x " * 50000 + TEMPLATES["gpl-3.0-line"]), (6, " ".join(TEMPLATES.values())), (6, " ".join(TEMPLATES.values()))]
    for k, (name, text) in enumerate(sorted(TEMPLATES.items()) * 5):
        found = text.split()
        for _ in range(k // 8):
            found[int(rng.integers(len(found)))] = f"changed{k}"
        rows.append((10 + k, " ".join([*number_words(0, int(rng.integers(0, 300))), *found, *number_words(400, int(rng.integers(0, 300)))])))
    result = license_scan.scan(docs(rows).selectExpr("*", "1 AS matches", "2 AS n_words")).collect()
    got = sorted((r["doc_id"], r["n_words"], tuple(sorted({m["template"] for m in r["matches"]}))) for r in result)
    assert got == sorted((i, len(words(t)), tuple(sorted(brute_force(t)))) for i, t in rows)
    assert license_scan.scan(docs([])).count() == 0


def test_spans_and_containment(docs):
    text = " ".join([*number_words(0, 9), *words(TEMPLATES["mit-line"]), *number_words(20, 9)])
    found = license_scan.scan(docs([(1, text)])).first()["matches"]
    assert [tuple(m) for m in found] == [("mit-line", 9, 13, 1.0)]


def test_a_template_needs_five_words():
    with pytest.raises(ValueError, match="fewer than 5"):
        license_scan.lengths({"short": "MIT License"})


def test_bands_reach_the_stated_probability():
    for length in license_scan.lengths(TEMPLATES):
        for found in length.sets:
            held = math.ceil(license_scan.CONTAINMENT * len(found))
            assert (1 - held / (length.size + len(found) - held)) ** length.bands <= license_scan.MISS


def test_whole_licenses_and_nearest_versions(docs):
    known = license_scan.covered()
    rng = np.random.default_rng(3)
    wanted = ["mit", "isc", "bsd-2-clause-text", "bsd-3-clause", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "apache-2.0", "mpl-2.0", "cc0-1.0"]
    wanted += ["gpl-2.0-notice-whole", "gpl-3.0-notice-whole", "agpl-3.0-notice-whole", "cc-by-4.0-notice", "cc-by-sa-3.0-notice", "mpl-2.0-notice"]
    rows = []
    for k, name in enumerate(wanted):
        text = words(known[name])
        for _ in range(len(text) // 100):
            text[int(rng.integers(len(text)))] = f"changed{k}"
        rows.append((k, " ".join([*number_words(0, 40), *text, *number_words(400, 40)])))
    rows += [(100, "Licensed under the MIT License."), (101, "Licensed under the GNU General Public License."), (102, f"{known['gpl-2.0']} {known['mit']}")]
    found = {r["doc_id"]: {m["template"] for m in r["matches"]} for r in license_scan.scan(docs(rows), known, nearest=True).collect()}
    assert [found[k] for k in range(len(wanted))] == [{name} for name in wanted]
    assert (found[100], found[101], found[102]) == ({"mit-line-1"}, {"gpl-line-1"}, {"gpl-2.0", "mit"})


def test_registered_scan_covers_whole_licenses(spark, docs, tmp_path):
    docs([(1, license_scan.covered()["isc"]), (2, "no license")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["licenses"] for r in license_scan.op4(spark, str(tmp_path)).collect()} == {1: "isc", 2: ""}
