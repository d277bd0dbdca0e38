"""Texts by which licenses are given: notices, SPDX lines, headers of source files, whole texts and first lines of long ones.

A form is (license, kind, text). Kinds: notice, spdx, header, text (a whole license), title (the beginning of a long license, which stands
at the beginning of a license file).
"""

from __future__ import annotations

# Short notices by which licenses are applied, by SPDX identifier.
NOTICES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This source code is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Identifiers that SPDX lines are looked for with.
SPDX = (*NOTICES, "BSD-2-Clause", "GPL-2.0", "ISC", "LGPL-2.1")
# Endings of the identifiers of GNU licenses.
GNU_SUFFIXES = ("", "-only", "-or-later")

# Headers of source files.
APACHE_HEADER = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the License.
"""
MPL_HEADER = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
GNU_HEADER = """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details. You should have received a copy of the GNU {name}
General Public License along with this program. If not, see https://www.gnu.org/licenses/.
"""
# Identifier, name and version of GNU licenses.
GNU = (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("LGPL-3.0", "Lesser", "3"), ("AGPL-3.0", "Affero", "3"))

# Whole texts.
MIT_TEXT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC_TEXT = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
BSD_TERMS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
UNLICENSE_TEXT = """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.
"""

# First lines of long licenses.
GNU_TITLE = """
GNU {name} GENERAL PUBLIC LICENSE Version {version}, {date} Copyright (C) {years} Free Software Foundation, Inc. Everyone is permitted to copy
and distribute verbatim copies of this license document, but changing it is not allowed.
"""
GNU_DATES = {
    "GPL-2.0": ("June 1991", "1989, 1991"), "GPL-3.0": ("29 June 2007", "2007"), "LGPL-2.1": ("February 1999", "1991, 1999"),
    "LGPL-3.0": ("29 June 2007", "2007"), "AGPL-3.0": ("19 November 2007", "2007"),
}
APACHE_TITLE = """
Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9
of this document.
"""
MPL_TITLE = """
Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the
creation of, or owns Covered Software.
"""
CC0_TITLE = """
Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES.
DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP.
"""


def longer_forms() -> list[tuple[str, str, str]]:
    """Every form but the short notices."""
    forms = []
    for name in SPDX:
        for suffix in GNU_SUFFIXES if "GPL" in name else ("",):
            forms.append((name, "spdx", f"SPDX-License-Identifier: {name}{suffix}"))
    for license_id, name, version in GNU:
        date, years = GNU_DATES[license_id]
        forms.append((license_id, "header", GNU_HEADER.format(name=name, version=version)))
        forms.append((license_id, "title", GNU_TITLE.format(name=name.upper(), version=version, date=date, years=years)))
    forms += [("Apache-2.0", "header", APACHE_HEADER), ("MPL-2.0", "header", MPL_HEADER)]
    forms += [("Apache-2.0", "title", APACHE_TITLE), ("MPL-2.0", "title", MPL_TITLE), ("CC0-1.0", "title", CC0_TITLE)]
    forms += [("MIT", "text", MIT_TEXT), ("ISC", "text", ISC_TEXT), ("Unlicense", "text", UNLICENSE_TEXT)]
    forms += [("BSD-2-Clause", "text", BSD_TERMS + BSD_DISCLAIMER), ("BSD-3-Clause", "text", BSD_TERMS + BSD_THIRD + BSD_DISCLAIMER)]
    return forms
