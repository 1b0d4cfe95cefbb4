"""The forms in which common licences are stated: notices, titles, and their texts."""

import re
from pathlib import Path

_TEXTS = Path(__file__).with_name("licence_texts")
# A reservation of rights says nothing where a licence is granted.
RESERVATION = "Proprietary"

_GPL_HEADER = (
    "This {kind} is free software: you can redistribute it and/or modify it under the terms of"
    " the GNU {name}General Public License as published by the Free Software Foundation,"
    " either version {version} of the License, or (at your option) any later version"
)
_GNU = "This work is licensed under the GNU {name}General Public License, version {version}"
_CC = "This work is licensed under a Creative Commons {name} 4.0 International License"
_CC_NAMES = {
    "BY": "Attribution",
    "BY-NC": "Attribution-NonCommercial",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

# Other notices, and the headers that licences give for source files.
NOTICES = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this'
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed"
        ' to in writing, software distributed under the License is distributed on an "AS IS"'
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the"
        " License for the specific language governing permissions and limitations under the"
        " License",
    ),
    "AGPL-3.0": (
        _GNU.format(name="Affero ", version="3"),
        _GPL_HEADER.format(kind="program", name="Affero ", version="3"),
    ),
    "BSD-2-Clause": ("Use of this source code is governed by a BSD 2-Clause license",),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the"
        " LICENSE file",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0",),
    "CC0-1.0": (
        "Licensed under CC0 1.0",
        "To the extent possible under law, the author has waived all copyright and related or"
        " neighboring rights to this work",
    ),
    "GPL-2.0": (
        _GNU.format(name="", version="2"),
        _GPL_HEADER.format(kind="program", name="", version="2"),
    ),
    "GPL-3.0": (_GPL_HEADER.format(kind="program", name="", version="3"),),
    "ISC": ("Released under the ISC License",),
    "LGPL-2.1": (
        _GNU.format(name="Lesser ", version="2.1"),
        _GPL_HEADER.format(kind="library", name="Lesser ", version="2.1"),
    ),
    "LGPL-3.0": (_GPL_HEADER.format(kind="library", name="Lesser ", version="3"),),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If"
        " a copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/",
    ),
    **{f"CC-{k}-4.0": (_CC.format(name=v), f"Licensed under CC {k} 4.0") for k, v in _CC_NAMES.items()},
}

# Titles. They count as a line of their own that has all their terms.
TITLES = {
    "AGPL-3.0": "GNU Affero General Public License version 3",
    "Apache-2.0": "Apache License",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License",
    "GPL-2.0": "GNU General Public License version 2",
    "GPL-3.0": "GNU General Public License version 3",
    "ISC": "ISC License",
    "LGPL-2.1": "GNU Lesser General Public License version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License version 3",
    "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License version 2.0",
    "Unlicense": "The Unlicense",
    "Zlib": "zlib License",
}

_IDENTIFIER = r"\(*[A-Za-z0-9][A-Za-z0-9.+:-]*\)*"
_TAG = re.compile(
    rf"(?i:SPDX-License-Identifier:)[ \t]*({_IDENTIFIER}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_IDENTIFIER})*)"
)


def tagged(text: str) -> str | None:
    """The licence expression of the first SPDX tag, as it is written."""
    for found in _TAG.finditer(text):
        expression = found[1].rstrip(".:-")
        if expression.count("(") != expression.count(")"):
            expression = expression.replace("(", "").replace(")", "")
        if expression not in ("NONE", "NOASSERTION"):
            return expression
    return None


def _affero(text: str) -> str:
    """The Affero text, from that of the GNU General Public License that it repeats."""
    text = re.sub(r"GNU GENERAL|GNU General|GNU GPL", r"GNU Affero General", text)
    network = (
        "  13. Remote Network Interaction; Use with the GNU General Public License.\n\n"
        "  Notwithstanding any other provision of this License, if you modify the Program, your"
        " modified version must prominently offer all users interacting with it remotely through"
        " a computer network (if your version supports such interaction) an opportunity to"
        " receive the Corresponding Source of your version by providing access to the"
        " Corresponding Source from a network server at no charge, through some standard or"
        " customary means of facilitating copying of software.\n\n  14. "
    )
    return re.sub(r"  13\. Use with.*?  14\. ", lambda _: network, text, count=1, flags=re.S)


def _commons(name: str, share_alike: str) -> str:
    """The text of a licence of Creative Commons, from that of Attribution-ShareAlike."""
    parts = share_alike.replace("Attribution-ShareAlike", name).split("\n\n")
    if "ShareAlike" not in name:
        first = next(n for n, x in enumerate(parts) if re.match(r"\s*b\. ShareAlike\.", x))
        last = next(n for n, x in enumerate(parts) if n > first and x.strip().startswith("Section 4"))
        parts[first:last] = []
        parts = [x for x in parts if not re.search("ShareAlike|BY-SA", x)]
    if "NonCommercial" in name:
        parts.append(
            "NonCommercial means not primarily intended for or directed towards commercial"
            " advantage or monetary compensation. For purposes of this Public License, the"
            " exchange of the Licensed Material for other material subject to Copyright and"
            " Similar Rights by digital file-sharing or similar means is NonCommercial provided"
            " there is no payment of monetary compensation in connection with the exchange."
            " reproduce and Share the Licensed Material, in whole or in part, for NonCommercial"
            " purposes only; and produce, reproduce, and Share Adapted Material for NonCommercial"
            " purposes only. including when the Licensed Material is used other than for"
            " NonCommercial purposes. a substantial portion of the contents of the database for"
            " NonCommercial purposes only"
        )
    if "NoDerivatives" in name:
        parts.append(
            "produce and reproduce, but not Share, Adapted Material. For the avoidance of doubt,"
            " You do not have permission under this Public License to Share Adapted Material."
            " provided You do not Share Adapted Material"
        )
    return "\n\n".join(parts)


def licence_texts() -> dict[str, str]:
    """The whole texts of licences by their identifiers."""
    found = {x.stem: x.read_text(encoding="utf-8") for x in sorted(_TEXTS.glob("*.txt"))}
    share_alike = found["CC-BY-SA-4.0"]
    found |= {f"CC-{k}-4.0": _commons(v, share_alike) for k, v in _CC_NAMES.items() if k != "BY-SA"}
    return found | {"AGPL-3.0": _affero(found["GPL-3.0"])}


def all_forms(short: dict[str, str]) -> dict[str, str]:
    """Every form by the identifier, a slash, and its kind: notice, title or text."""
    forms = {f"{name}/notice": text for name, text in short.items()}
    for name, texts in NOTICES.items():
        forms |= {f"{name}/notice{n}": text for n, text in enumerate(texts, 1)}
    forms |= {f"{name}/title": text for name, text in TITLES.items()}
    return forms | {f"{name}/text": text for name, text in licence_texts().items()}
