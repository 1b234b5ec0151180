"""License notices and short lines, with the phrases that tell them apart.

Fixed values: public texts, as their licences ask for them, without the names of
holders.  Whole notices are ``notice``; parts that also stand alone are templates
of their own (``permission``, ``grant``, ``conditions``, ``redistribution``).  The
list is bounded and names only the licences below.
"""

from __future__ import annotations

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS {} BE
    LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
    IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
    Software, and to permit persons to whom the Software is furnished to do so"""

_MIT_IF = """, subject to the following conditions: The above copyright notice and this permission notice shall be included in
    all copies or substantial portions of the Software."""

_BSD_1 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: {}Redistributions of source code must retain the above copyright notice, this list of conditions
    and the following disclaimer."""

_BSD_2 = """ 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
    following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_3 = """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""

_BSD_AS_IS = """ THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
    INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
    IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
    PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
    TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""

_ISC_IF = ", provided that the above copyright notice and this permission notice appear in all copies."

_ISC_AS_IS = """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
    OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
    CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_GNU = """This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} License
    as published by the Free Software Foundation{end} either version {version} of the License, or (at your option) any later
    version."""

_GNU_REST = """ This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
    implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} License for more details. You should
    have received a copy of the GNU {kind} License along with this {thing}{address}"""

_POST = """; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""
_SITE = ". If not, see <https://www.gnu.org/licenses/>."

TEMPLATES: list[tuple[str, str, str]] = []
#: (license, template) -> phrases, each of which stands in every match.
PHRASES: dict[tuple[str, str], list[str]] = {}


def _add(license: str, template: str, text: str, *phrases: str) -> None:
    TEMPLATES.append((license, template, text))
    PHRASES[license, template] = list(phrases)


_add("MIT", "line", "Released under the MIT License.", "mit")
_add("MIT", "permission", _MIT + _MIT_IF, "copyright notice")
_add("MIT", "notice", _MIT + _MIT_IF + " " + _AS_IS.format("OR COPYRIGHT HOLDERS"), "copyright notice")
_add("MIT-0", "notice", _MIT + ". " + _AS_IS.format("OR COPYRIGHT HOLDERS"))
_add("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0.", "apache", "version 2")
_add("Apache-2.0", "notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
    compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
    required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
    IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
    language governing permissions and limitations under the License.""", "apache", "version 2")
_add("BSD-2-Clause", "line", "Licensed under the BSD 2-Clause License.", "bsd 2")
_add("BSD-2-Clause", "conditions", _BSD_1.format("1. ") + _BSD_2)
_add("BSD-2-Clause", "notice", _BSD_1.format("1. ") + _BSD_2 + _BSD_AS_IS)
_add("BSD-3-Clause", "line", "Licensed under the BSD 3-Clause License.", "bsd 3")
_add("BSD-3-Clause", "conditions", _BSD_1.format("1. ") + _BSD_2 + _BSD_3, "endorse")
_add("BSD-3-Clause", "notice", _BSD_1.format("1. ") + _BSD_2 + _BSD_3 + _BSD_AS_IS, "endorse")
_add("BSD", "redistribution", _BSD_1.format(""))  # the number of clauses is open
_add("ISC", "line", "Released under the ISC License.", "isc")
_add("ISC", "permission", _ISC + _ISC_IF, "copyright notice")
_add("ISC", "notice", _ISC + _ISC_IF + _ISC_AS_IS, "copyright notice")
_add("0BSD", "notice", _ISC + "." + _ISC_AS_IS)
_add("MPL-2.0", "line", "Licensed under the Mozilla Public License, version 2.0.", "mozilla public", "2 0")
_add("MPL-2.0", "notice", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
    was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "mozilla public", "2 0")

for _name, _kind, _version, _thing, _rest in (
        ("GPL-2.0", "General Public", "2", "program", _POST), ("GPL-3.0", "General Public", "3", "program", _SITE),
        ("LGPL-2.0", "Library General Public", "2", "library", _POST), ("LGPL-2.1", "Lesser General Public", "2.1", "library", _POST),
        ("LGPL-3.0", "Lesser General Public", "3", "program", _SITE), ("AGPL-3.0", "Affero General Public", "3", "program", _SITE)):
    _phrases = (f"gnu {_kind.lower()}", "version " + _version.replace(".", " "))
    _values = {"thing": _thing, "kind": _kind, "version": _version, "address": _rest, "mark": ":", "end": ","}
    _add(_name, "line", f"This work is licensed under the GNU {_kind} License, version {_version}.", *_phrases)
    _add(_name, "line_v", f"Licensed under the GNU {_kind} License v{_version}.", _phrases[0], "v" + _version.replace(".", " "))
    _add(_name, "grant", _GNU.format(**_values), *_phrases)
    _add(_name, "notice", _GNU.format(**_values) + _GNU_REST.format(**_values), *_phrases)

for _name, _short, _long in (
        ("CC-BY-4.0", "BY", "Attribution"), ("CC-BY-SA-4.0", "BY-SA", "Attribution-ShareAlike"),
        ("CC-BY-NC-4.0", "BY-NC", "Attribution-NonCommercial"), ("CC-BY-ND-4.0", "BY-ND", "Attribution-NoDerivatives"),
        ("CC-BY-NC-SA-4.0", "BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("CC-BY-NC-ND-4.0", "BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    _named = f"This work is licensed under a Creative Commons {_long} 4.0 International License."
    _phrase = _long.lower().replace("-", " ") + " 4"
    _add(_name, "line", f"Licensed under CC {_short} 4.0.", f"cc {_short.lower().replace('-', ' ')} 4")
    _add(_name, "notice", _named, _phrase)
    _add(_name, "letter", f"""{_named} To view a copy of this license, visit http://creativecommons.org/licenses/{_short.lower()}/4.0/
        or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.""", _phrase)

_add("CC0-1.0", "line", "Released under CC0 1.0 Universal.", "cc0 1 0")
_add("CC0-1.0", "notice", """To the extent possible under law, the author has waived all copyright and related or neighboring rights to
    this work.""", "waived all copyright")
_add("Unlicense", "line", "Released under the Unlicense.", "unlicense")
_add("Unlicense", "notice", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
    publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
    commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
    software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit
    of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
    relinquishment in perpetuity of all present and future rights to this software under copyright law. """ + _AS_IS.format("")
     + " For more information, please refer to <https://unlicense.org>", "unencumbered")

for _name in dict.fromkeys(t[0] for t in TEMPLATES):
    if _name != "BSD":
        _add(_name, "spdx", f"SPDX-License-Identifier: {_name}", "identifier " + _name.lower().replace("-", " ").replace(".", " "))
