"""Standard titles, header paragraphs and bodies of licenses, and short forms of notices.

Several per license, besides the notices of ``licenses.TEMPLATES``. Of long licenses there are the title
with the lines that stand under it and the header for source files; short ones are here as a whole.
Relatives that differ in a version or a clause are listed so that they aren't taken for one another.
"""

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_4 = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization. 4"
)
_BSD_REST = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_0BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC = _0BSD + ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_REST = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
    "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
    "THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_UNLICENSE_REST = (
    " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate "
    "any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment "
    "of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
    "software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE. For more information, please refer to http://unlicense.org/"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
    "use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
    "the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
    "3. This notice may not be removed or altered from any source distribution."
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at"
)
_APACHE_REST = (
    " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License."
)
_ASF = (
    "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for "
    "additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\"); "
    "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
)
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


def _gnu(license: str, name: str, short: str, version: str, date: str) -> list[tuple[str, str]]:
    """Title, source headers of the two wordings, and notices of one license of the GNU family."""
    work = "library" if short == "LGPL" and version < "3" else "program"
    headers = [
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, "
        f"either version {version} of the License, or (at your option) any later version.",
        f"This {work} is free software; you can redistribute it and/or modify it under the terms of the {name} version {version} as published by the "
        "Free Software Foundation.",
    ]
    rest = (
        f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        f"FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this {work}. "
        "If not, see http://www.gnu.org/licenses/."
    )
    title = f"{name} Version {version}, {date}"
    v = version.removesuffix(".0")
    notices = [f"{name} v{v}", f"{name} Version {version} or later", f"Licensed under the {short} version {version}", f"License: {short}v{v}", f"License: {short}v{v}+", f"License: {short} {version}"]
    return [(license, t) for t in [title, f"{title} Copyright (C) Free Software Foundation, Inc. {_VERBATIM}", *headers, *(h + rest for h in headers), *notices]]


def _creative(code: str, kind: str) -> list[tuple[str, str]]:
    """Title and notices of the Creative Commons licenses of one kind, by version."""
    return [
        (f"CC-{code}-{version}", text)
        for version, place in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
        for text in (
            f"Creative Commons {kind} {version} {place} Public License", f"{kind} {version} {place}", f"Licensed under CC {code} {version}.",
            f"This work is licensed under a Creative Commons {kind} {version} {place} License.",
        )
    ]


_GPL, _LGPL = "GNU General Public License", "GNU Lesser General Public License"
STANDARD: list[tuple[str, str]] = [
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("MIT", "Licensed under the MIT license."), ("MIT", _MIT), ("MIT", _MIT + _MIT_REST), ("MIT", "License: MIT"),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-2-Clause", "Simplified BSD License"), ("BSD-2-Clause", _BSD_2 + _BSD_REST), ("BSD-2-Clause", "License: BSD-2-Clause"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "New BSD License"), ("BSD-3-Clause", "Modified BSD License"), ("BSD-3-Clause", "License: BSD-3-Clause"),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_REST), ("BSD-4-Clause", _BSD_2 + _BSD_4 + _BSD_3[1:] + _BSD_REST),
    ("ISC", "ISC License"), ("ISC", _ISC), ("ISC", _ISC + _ISC_REST), ("ISC", "License: ISC"), ("0BSD", _0BSD), ("0BSD", _0BSD + "." + _ISC_REST), ("0BSD", "BSD Zero Clause License"),
    ("Unlicense", _UNLICENSE + _UNLICENSE_REST), ("Unlicense", "The Unlicense"), ("Unlicense", "License: Unlicense"), ("Zlib", _ZLIB), ("Zlib", "zlib License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "License: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"), ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_REST),
    ("Apache-2.0", _ASF), ("Apache-2.0", _ASF + _APACHE_REST),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-2.0", "Licensed under the MPL 2.0"), ("MPL-2.0", "License: MPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance "
                "with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"), ("EPL-2.0", "License: EPL-2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
                "https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
                "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    *_gnu("GPL-1.0", _GPL, "GPL", "1", "February 1989"), *_gnu("GPL-2.0", _GPL, "GPL", "2", "June 1991"), *_gnu("GPL-3.0", _GPL, "GPL", "3", "29 June 2007"),
    *_gnu("LGPL-2.0", "GNU Library General Public License", "LGPL", "2", "June 1991"), *_gnu("LGPL-2.1", _LGPL, "LGPL", "2.1", "February 1999"),
    *_gnu("LGPL-3.0", _LGPL, "LGPL", "3", "29 June 2007"), *_gnu("AGPL-3.0", "GNU Affero General Public License", "AGPL", "3", "19 November 2007"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002"), ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("CC0-1.0", "CC0 1.0 Universal"), ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"), ("CC0-1.0", "License: CC0-1.0"),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain "
                "worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software. "
                "If not, see http://creativecommons.org/publicdomain/zero/1.0/."),
    *_creative("BY", "Attribution"), *_creative("BY-SA", "Attribution-ShareAlike"), *_creative("BY-NC", "Attribution-NonCommercial"),
    *_creative("BY-ND", "Attribution-NoDerivatives"), *_creative("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    *_creative("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]
