"""Public license notices and texts, under their short names, and
the words that tell each from its neighbours. Whole texts lie in ``licenses``."""

import re
from importlib.resources import files

TEMPLATES = {
    "Apache-2.0 (line)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "CC-BY-4.0 (line)": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 (line)": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 (line)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MIT (line)": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means.""",
}

_CONDITIONS = TEMPLATES["BSD-2-Clause"]
_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following
    acknowledgement: This product includes software developed by the organization."""
_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
    OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
    LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
    THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
    CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
    THE SOFTWARE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
    INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
    SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
    PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
    THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_GNU_NOTICE = """This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU
    {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option)
    any later version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
    even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more
    details."""

TEMPLATES |= {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted. """ + _ISC_DISCLAIMER,
    "BSD-2-Clause (full)": _CONDITIONS + _BSD_DISCLAIMER,
    "BSD-3-Clause": _CONDITIONS + " 3. " + _ENDORSE,
    "BSD-3-Clause (full)": _CONDITIONS + " 3. " + _ENDORSE + _BSD_DISCLAIMER,
    "BSD-4-Clause": _CONDITIONS + _ADVERTISING + " 4. " + _ENDORSE,
    "BSD-4-Clause (full)": _CONDITIONS + _ADVERTISING + " 4. " + _ENDORSE + _BSD_DISCLAIMER,
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
        distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
        third-parties to whom the Software is furnished to do so, all subject to the following:""",
    "EPL-1.0": """All rights reserved. This program and the accompanying materials are made available under the terms of
        the Eclipse Public License v1.0 which accompanies this distribution, and is available at
        http://www.eclipse.org/legal/epl-v10.html""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "ISC (full)": TEMPLATES["ISC"] + " " + _ISC_DISCLAIMER,
    "MIT (full)": TEMPLATES["MIT"] + " " + _MIT_DISCLAIMER,
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so. """ + _MIT_DISCLAIMER,
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that
        you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
        and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from
        any source distribution.""",
}

#: Phrases that must be matched word after word, besides the coverage.
TELLING: dict[str, tuple[str, ...]] = {
    "Apache-2.0 (line)": ("Apache License, Version 2.0",), "Apache-2.0": ("Apache License, Version 2.0",),
    "BSD-3-Clause": ("endorse or promote",), "BSD-3-Clause (full)": ("endorse or promote",),
    "BSD-4-Clause": ("following acknowledgement",), "BSD-4-Clause (full)": ("following acknowledgement",),
    "CC-BY-4.0 (line)": ("Creative Commons Attribution 4.0",), "CC-BY-NC-4.0 (line)": ("CC BY-NC 4.0",),
    "EPL-1.0": ("Eclipse Public License v1.0",), "EPL-2.0": ("Eclipse Public License 2.0",),
    "GPL-3.0 (line)": ("GNU General Public License, version 3",),
    "GPL-3.0": ("GNU General Public License", "either version 3"),
    "MIT (line)": ("MIT License",), "MPL-2.0": ("Mozilla Public License, v. 2.0",),
}
#: Words that must not stand in a match or in the 30 words behind it.
BARRED = {"BSD-2-Clause": ("endorse", "acknowledgement"), "BSD-2-Clause (full)": ("endorse", "acknowledgement"),
          "BSD-3-Clause": ("acknowledgement",), "BSD-3-Clause (full)": ("acknowledgement",)}
#: Whole texts: they are looked for where their heading stands.
HEADINGS = {
    "Apache-2.0 (full)": ("Apache-2.0", "Apache License Version 2.0"),
    "Artistic-1.0 (full)": ("Artistic", 'The "Artistic License" Preamble'),
    "CC0-1.0 (full)": ("CC0-1.0", "Creative Commons Legal Code CC0 1.0"),
    "GFDL-1.2 (full)": ("GFDL-1.2", "GNU Free Documentation License Version 1.2"),
    "GFDL-1.3 (full)": ("GFDL-1.3", "GNU Free Documentation License Version 1.3"),
    "GPL-1.0 (full)": ("GPL-1", "GNU General Public License Version 1"),
    "GPL-2.0 (full)": ("GPL-2", "GNU General Public License Version 2"),
    "GPL-3.0 (full)": ("GPL-3", "GNU General Public License Version 3"),
    "LGPL-2.0 (full)": ("LGPL-2", "GNU Library General Public License Version 2"),
    "LGPL-2.1 (full)": ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    "LGPL-3.0 (full)": ("LGPL-3", "GNU Lesser General Public License Version 3"),
    "MPL-1.1 (full)": ("MPL-1.1", "Mozilla Public License Version 1.1"),
    "MPL-2.0 (full)": ("MPL-2.0", "Mozilla Public License Version 2.0"),
}
for _name, (_file, _heading) in HEADINGS.items():
    TEMPLATES[_name] = (files(__package__) / "licenses" / f"{_file}.txt").read_text("utf-8")
    TELLING[_name] = (_heading,)

# notices of the GNU licenses, as programs and as libraries
for _name, _long, _version in [
        ("GPL-1.0", "General Public License", "1"), ("GPL-2.0", "General Public License", "2"),
        ("LGPL-2.0", "Library General Public License", "2"), ("LGPL-2.1", "Lesser General Public License", "2.1"),
        ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3")]:
    TEMPLATES[_name] = _GNU_NOTICE.format(work="library" if _name[0] == "L" else "program", mark=":", name=_long, version=_version)
    TELLING[_name] = (f"GNU {_long}", f"either version {_version} of")

# one-line notices: by the full name, and by the short one
_LINES = [("GPL-" + v, f"GNU General Public License, version {n}", (f"GPL-{v}", f"GPLv{n}", f"GPL v{n}", f"GPL {n}"))
          for v, n in (("1.0", "1"), ("2.0", "2"), ("3.0", "3"))]
_LINES += [("LGPL-" + v, f"GNU Lesser General Public License, version {n}", (f"LGPL-{v}", f"LGPLv{n}", f"LGPL v{n}", f"LGPL {n}"))
           for v, n in (("2.1", "2.1"), ("3.0", "3"))]
_LINES += [
    ("LGPL-2.0", "GNU Library General Public License, version 2", ("LGPL-2.0", "LGPLv2", "LGPL v2", "LGPL 2")),
    ("AGPL-3.0", "GNU Affero General Public License, version 3", ("AGPL-3.0", "AGPLv3", "AGPL v3", "AGPL 3")),
    ("Apache-1.1", "Apache License, Version 1.1", ("Apache-1.1", "Apache License 1.1")),
    ("Apache-2.0", "Apache License, Version 2.0", ("Apache-2.0", "the Apache License 2.0")),
    ("Artistic-2.0", "Artistic License, Version 2.0", ("Artistic-2.0", "the Artistic License 2.0")),
    ("BSD", "BSD License", ()), ("BSD-2-Clause", "BSD 2-Clause License", ("BSD-2-Clause", "the 2-Clause BSD License")),
    ("BSD-3-Clause", "BSD 3-Clause License", ("BSD-3-Clause", "the 3-Clause BSD License")),
    ("BSL-1.0", "Boost Software License, Version 1.0", ("BSL-1.0", "the Boost Software License 1.0")),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal License", ("CC0 1.0",)),
    ("CDDL-1.0", "Common Development and Distribution License, Version 1.0", ("CDDL-1.0",)),
    ("EPL-1.0", "Eclipse Public License, Version 1.0", ("EPL-1.0", "the Eclipse Public License 1.0")),
    ("EPL-2.0", "Eclipse Public License, Version 2.0", ("EPL-2.0", "the Eclipse Public License 2.0")),
    ("ISC", "ISC License", ()), ("MIT", "MIT License", ()),
    ("MPL-1.1", "Mozilla Public License, Version 1.1", ("MPL-1.1", "the Mozilla Public License 1.1")),
    ("MPL-2.0", "Mozilla Public License, Version 2.0", ("MPL-2.0", "the Mozilla Public License 2.0")),
    ("Zlib", "zlib License", ()),
]
_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    for _version, _scope in (("1.0", ""), ("2.0", ""), ("2.5", ""), ("3.0", " Unported"), ("4.0", " International")):
        _long = "-".join(_PARTS[p] for p in _kind.split("-"))
        if _version != "4.0":
            _long = _long.replace("NoDerivatives", "NoDerivs")
        _LINES.append((f"CC-{_kind}-{_version}", f"Creative Commons {_long} {_version}{_scope} License", (f"CC {_kind} {_version}",)))
_SEEN = {tuple(re.findall(r"[^\W_]+", t.lower())) for t in TEMPLATES.values()}
for _name, _long, _short in _LINES:
    _telling = _long.removesuffix(" License").removesuffix(" Unported").removesuffix(" International")
    for _kind, _text, _phrase in [("line", f"Licensed under the {_long}.", _telling),
                                  *[(f"short line {k}", f"Licensed under {s}.", s.removeprefix("the ")) for k, s in enumerate(_short, 1)]]:
        _key = f"{_name} ({_kind})" if f"{_name} ({_kind})" not in TEMPLATES else f"{_name} (licensed line)"
        _words = tuple(re.findall(r"[^\W_]+", _text.lower()))
        if _words not in _SEEN:
            _SEEN.add(_words)
            TEMPLATES[_key], TELLING[_key] = _text, (_phrase,)
