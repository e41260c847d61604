"""Titles, notices and short texts of public licences, as their publishers give them."""

from __future__ import annotations

from dataclasses import dataclass

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TERMS = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
_UNLICENSE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
_BOOST = 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
_GNU = "This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation{comma} either version {version} of the License, or (at your option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."


def _gnu(name: str, version: str) -> str:
    return _GNU.format(what="program", colon=":", comma=",", name=name, version=version)


@dataclass(frozen=True)
class Template:
    license: str
    text: str
    #: Words that a unit of text must have: a short statement differs from that of another licence by its name alone.
    must: tuple[str, ...] = ()


TEMPLATES: tuple[Template, ...] = (
    # short statements
    Template("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", ("affero", "3")),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache",)),
    Template("BSD-3-Clause", "Released under the BSD 3-Clause License.", ("bsd", "3")),
    Template("BSD-2-Clause", "Released under the BSD 2-Clause License.", ("bsd", "2")),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0.", ("cc", "by", "4")),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", ("cc", "by", "nc", "4")),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", ("cc", "by", "sa", "4")),
    Template("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal.", ("cc0",)),
    Template("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu", "2")),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu", "3")),
    Template("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1.", ("lesser", "2")),
    Template("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", ("lesser", "3")),
    Template("MIT", "Released under the MIT License.", ("mit",)),
    Template("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0.", ("mozilla",)),
    # titles
    Template("MIT", "MIT License", ("mit",)),
    Template("ISC", "ISC License", ("isc",)),
    Template("BSD-2-Clause", "BSD 2-Clause License", ("bsd", "2")),
    Template("BSD-3-Clause", "BSD 3-Clause License", ("bsd", "3")),
    Template("Apache-2.0", "Apache License", ("apache",)),
    Template("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", ("apache",)),
    Template("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ("gnu", "2")),
    Template("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("gnu", "3")),
    Template("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", ("lesser", "2")),
    Template("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("lesser", "3")),
    Template("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ("affero", "3")),
    Template("MPL-2.0", "Mozilla Public License Version 2.0", ("mozilla",)),
    Template("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003", ("boost",)),
    Template("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal", ("cc0",)),
    Template("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License", ("commons", "attribution")),
    Template("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License", ("commons", "sharealike")),
    Template("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License", ("commons", "noncommercial")),
    # notices at the head of files
    Template("Apache-2.0", _APACHE, ("apache",)),
    Template("MPL-2.0", _MPL, ("mozilla",)),
    Template("GPL-2.0", _gnu("GNU General Public License", "2"), ("gnu", "2")),
    Template("GPL-3.0", _gnu("GNU General Public License", "3"), ("gnu", "3")),
    Template("LGPL-2.1", _gnu("GNU Lesser General Public License", "2.1"), ("lesser", "2")),
    Template("LGPL-3.0", _gnu("GNU Lesser General Public License", "3"), ("lesser", "3")),
    Template("AGPL-3.0", _gnu("GNU Affero General Public License", "3"), ("affero", "3")),
    # whole texts, and the paragraphs that only they have
    Template("MIT", f"MIT License Copyright (c) {_MIT_GRANT} {_MIT_NOTICE} {_AS_IS}"),
    Template("MIT", _MIT_GRANT),
    Template("BSD-2-Clause", f"Copyright (c) All rights reserved. {_BSD_GRANT} {_BSD_TERMS} {_BSD_AS_IS}"),
    Template("BSD-3-Clause", f"Copyright (c) All rights reserved. {_BSD_GRANT} {_BSD_TERMS} {_BSD_NAME} {_BSD_AS_IS}", ("endorse",)),
    Template("ISC", f"Copyright (c) {_ISC_GRANT} {_ISC_AS_IS}"),
    Template("ISC", _ISC_GRANT),
    Template("Zlib", _ZLIB),
    Template("Unlicense", _UNLICENSE),
    Template("BSL-1.0", _BOOST),
    # reserved rights: only where nothing else is found
    Template("Proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited.", ("rights", "reserved")),
    Template("Proprietary", "All rights reserved.", ("rights", "reserved")),
)
#: Licences that count only where no other one is found.
LAST_RESORT = ("Proprietary",)
