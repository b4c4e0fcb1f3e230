"""Notices beyond `licenses.TEMPLATES`: short notices, file headers and licence texts with every version under its own name.

A name is that of the licence in the SPDX list, with the form of the notice behind it (`-header`, `-text`, `-full`).
"""

from __future__ import annotations

from pathlib import Path

_GNU = {
    "GPL": ("General Public License", ("1.0", "2.0", "3.0")),
    "LGPL": ("Lesser General Public License", ("2.1", "3.0")),
    "AGPL": ("Affero General Public License", ("1.0", "3.0")),
}
_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the copyright holder. 4. Neither the name of the copyright holder nor the "
    "names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission. "
)
_NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)


def _gnu() -> dict[str, str]:
    out = {}
    for short, (name, versions) in _GNU.items():
        for version in versions:
            spoken = version.removesuffix(".0")
            if (short, version) != ("GPL", "3.0"):  # a template already
                out[f"{short}-{version}"] = f"This work is licensed under the GNU {name}, version {spoken}."
                out[f"{short}-{version}-header"] = (
                    f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
                    f"as published by the Free Software Foundation, either version {spoken} of the License, or (at your option) "
                    "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
                    f"GNU {name} for more details. You should have received a copy of the GNU {name} along with this program. "
                    "If not, see <https://www.gnu.org/licenses/>."
                )
            out[f"{short}-{version}-short"] = f"Released under the {short} version {spoken}."
            out[f"{short}-{version}-only-header"] = (
                f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
                f"version {spoken} as published by the Free Software Foundation."
            )
    return out


def _cc() -> dict[str, str]:
    out = {}
    for short, name in _CC.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            kind = "International" if version == "4.0" else "Unported" if version == "3.0" else "Generic"
            out[f"CC-{short}-{version}-notice"] = f"This work is licensed under a Creative Commons {name} {version} {kind} License."
            out[f"CC-{short}-{version}-short"] = f"Licensed under CC {short} {version}."
    for held in ("CC-BY-4.0-notice", "CC-BY-SA-4.0-notice", "CC-BY-NC-4.0-short"):  # templates already
        del out[held]
    return out


def _full() -> dict[str, str]:
    folder = Path(__file__).parent / "license_texts"
    return {f"{path.stem}-full": path.read_text(encoding="utf-8") for path in sorted(folder.glob("*.txt"))}


FORMS: dict[str, str] = {
    **_gnu(),
    **_cc(),
    **_full(),
    "Apache-1.1": "Licensed under the Apache Software License, Version 1.1.",
    "0BSD-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted. " + _NO_WARRANTY
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. " + _NO_WARRANTY
    ),
    "BSD-2-Clause-text": _CLAUSES + _AS_IS,
    "BSD-3-Clause-text": _CLAUSES + _THIRD + _AS_IS,
    "BSD-4-Clause-text": _CLAUSES + _ADVERTISING + _AS_IS,
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-style-file": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
        "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or "
        "derivative works are solely in the form of machine-executable object code generated by a source language processor. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE."
    ),
    "CC0-1.0": "This work is released under CC0 1.0 Universal.",
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "MPL-1.1-header": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ "
        'Software distributed under the License is distributed on an "AS IS" basis, WITHOUT WARRANTY OF ANY KIND, either express '
        "or implied. See the License for the specific language governing rights and limitations under the License."
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
        "any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
}
