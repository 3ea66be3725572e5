"""Wordings of well-known licences and notices, by family, and words that mark them.

A family that is another one with more said (``SPECIAL``) shares the other's texts; only what it
says beyond them is listed under it.
"""

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
    "PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(name: str, spdx: str, *more: str) -> list[str]:
    return [
        f"licensed under the GNU {name} Public License, version 3", f"licensed under the GNU {name} Public License",
        f"GNU {name} Public License Version 2", f"GNU {name} Public License Version 3",
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {name} Public License for more details.",
        f"You should have received a copy of the GNU {name} Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/",
        *(f"SPDX-License-Identifier: {spdx}-{version}" for version in (
            "2.0-only", "2.0-or-later", "2.1-only", "2.1-or-later", "3.0-only", "3.0-or-later")), *more]


TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0", "Released under the Apache License 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND "
        "DISTRIBUTION", "SPDX-License-Identifier: Apache-2.0"],
    "mit": [
        "Released under the MIT License", "Licensed under the MIT license", "The MIT License (MIT) Copyright (c)", _MIT,
        "SPDX-License-Identifier: MIT"],
    "x11": [
        "Released under the X11 License", "Licensed under the X11 license",
        "Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote "
        "the sale, use or other dealings in this Software without prior written authorization from the X Consortium.",
        "SPDX-License-Identifier: X11"],
    "isc": [
        "Released under the ISC License", "Licensed under the ISC license", "ISC License Copyright (c)",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "SPDX-License-Identifier: ISC"],
    "bsd": ["Released under the BSD License", "Licensed under the BSD license", "Use of this source code is governed by a BSD-style "
            "license that can be found in the LICENSE file", _BSD, _BSD_END],
    "bsd-2-clause": [
        "Licensed under the BSD 2-Clause License", "BSD 2-Clause License", "Released under the Simplified BSD License",
        "in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT "
        "HOLDERS AND CONTRIBUTORS AS IS", "SPDX-License-Identifier: BSD-2-Clause"],
    "bsd-3-clause": [
        "Licensed under the BSD 3-Clause License", "BSD 3-Clause License", "Released under the New BSD License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.", "SPDX-License-Identifier: BSD-3-Clause"],
    "gpl": _gnu("General", "GPL", "This work is licensed under the GNU General Public License, version 3",
                "Released under the GPL license"),
    "lgpl": _gnu("Lesser General", "LGPL", "Released under the LGPL license",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation"),
    "agpl": _gnu("Affero General", "AGPL", "Released under the AGPL license"),
    "mozilla": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "eclipse": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/", "Licensed under the Eclipse Public License 1.0",
        "Eclipse Public License v 2.0", "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: EPL-1.0"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.", "Released under the Unlicense license",
        "For more information, please refer to https://unlicense.org", "SPDX-License-Identifier: Unlicense"],
    "cc0": [
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide.", "Released under the CC0 1.0 Universal license",
        "This work is marked with CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal license",
        "SPDX-License-Identifier: CC0-1.0"],
    "creative commons": [
        "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0", "Licensed under CC BY-SA 4.0", "Licensed under CC BY-NC-ND 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/", "SPDX-License-Identifier: CC-BY-4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "artistic": [
        "Licensed under the Artistic License 2.0", "The Artistic License 2.0 Copyright (c) 2000-2006, The Perl Foundation",
        "you can redistribute it and/or modify it under the terms of the Artistic License", "SPDX-License-Identifier: Artistic-2.0"],
    "zlib": [
        "Released under the zlib license", "Licensed under the zlib/libpng license",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "This notice may not be removed or altered from any source distribution.", "SPDX-License-Identifier: Zlib"],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0", "Licensed under the Boost Software License",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software",
        "See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt", "SPDX-License-Identifier: BSL-1.0"],
    "all rights reserved": [
        "All rights reserved", "Copyright by the authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form or by any means without the prior "
        "written permission of the publisher"],
}

#: What a family adds to another one; where it is found, the other is not named, too.
SPECIAL = {"x11": "mit", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd"}

#: Any 32 words of a template, or all of a shorter one, hold one of these.
MARKERS = (
    "license licenses licensed licence licences copyright rights reserved spdx permission permitted software cc cc0 "
    "redistribution redistributions redistribute liability liable warranty warranties damages unlicense creativecommons gnu "
    "unencumbered merchantability publication loss profits negligence contributors distribute").split()
