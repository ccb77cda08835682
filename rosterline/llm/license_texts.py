"""Texts by which works are licensed: whole licenses (files in ``licenses``), notices and statement lines."""

from __future__ import annotations

from pathlib import Path

_GNU = "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
_CC = "This work is licensed under a Creative Commons {name} {version} License."

GNU = {"gpl": "General Public License", "lgpl": "Lesser General Public License", "agpl": "Affero General Public License"}
GNU_VERSIONS = {"gpl": ("2", "3"), "lgpl": ("2.1", "3"), "agpl": ("3",)}
CREATIVE_COMMONS = {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"2.0": "2.0 Generic", "2.5": "2.5 Generic", "3.0": "3.0 Unported", "4.0": "4.0 International"}

NOTICES = {
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mpl-1.1-notice": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing rights and limitations under the License.",
    "cc0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
}
for _key, _versions in GNU_VERSIONS.items():
    for _version in _versions:
        for _thing in ("program", "library") if _key == "lgpl" else ("program",):
            _name = f"{_key}-{_version if '.' in _version else _version + '.0'}-notice-whole"
            NOTICES[_name + ("-library" if _thing == "library" else "")] = _GNU.format(thing=_thing, name=GNU[_key], version=_version)
for _key, _name in CREATIVE_COMMONS.items():
    for _version, _long in CC_VERSIONS.items():
        NOTICES[f"cc-{_key}-{_version}-notice"] = _CC.format(name=_name, version=_long)

VERBS = ("licensed", "released", "distributed", "available", "published", "provided")
# License: whether "the" goes before its names, and these.
NAMES = {
    "mit": (True, ["MIT License"]), "isc": (True, ["ISC License"]), "zlib": (True, ["zlib License"]), "bsd": (True, ["BSD License"]),
    "bsd-2-clause": (True, ["BSD 2-Clause License", "2-Clause BSD License"]), "bsd-3-clause": (True, ["BSD 3-Clause License", "3-Clause BSD License"]),
    "apache": (True, ["Apache License"]), "apache-2.0": (True, ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"]),
    "mpl": (True, ["Mozilla Public License"]), "mpl-1.1": (True, ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1"]),
    "mpl-2.0": (True, ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0"]),
    "cc0-1.0": (False, ["CC0 1.0 Universal"]),
}
for _key, _versions in GNU_VERSIONS.items():
    NAMES[_key] = (True, [f"GNU {GNU[_key]}"])
    for _version in _versions:
        _long = _version if "." in _version else _version + ".0"
        NAMES[f"{_key}-{_long}"] = (True, [f"GNU {GNU[_key]}{mark}{v}" for mark in (", version ", " v") for v in sorted({_version, _long})])
for _key in CREATIVE_COMMONS:
    for _version in CC_VERSIONS:
        NAMES[f"cc-{_key}-{_version}"] = (False, [f"CC {_key.upper()} {_version}"])


def lines() -> dict[str, str]:
    """Statements such as ``licensed under the MIT License``, by the license's name, ``line`` and a number."""
    found = {}
    for key, (article, names) in NAMES.items():
        the = "the " if article else ""
        texts = [f"{verb} under {the}{name}" for name in names for verb in VERBS] + [f"under the terms of {the}{name}" for name in names]
        found |= {f"{key}-line-{n}": text for n, text in enumerate(texts, 1)}
    return found


def whole_texts() -> dict[str, str]:
    return {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
