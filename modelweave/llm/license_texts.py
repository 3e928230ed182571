"""Whole short licences as templates for ``license_markup``.

``[[ ... ]]`` may be left out and ``{{most: pattern}}`` be replaced; every other word is mandatory. The labels tell
that the whole text stands there, not only its name or first sentence.
"""

from __future__ import annotations

_HOLDER = r"{{16: .+}}"  # who gives the licence: any words
_ITEM = r"{{1: \d|[abc]}}"  # the number or letter of a list item

# The public wording of the licences.
_MIT = r"""
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND [[NONINFRINGEMENT|NON-INFRINGEMENT]]. IN NO EVENT
SHALL """ + _HOLDER + r""" BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_ISC = r"""
Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND """ + _HOLDER + r""" DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL """ + _HOLDER + r""" BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_ZLIB = r"""
This software is provided 'as-is', without any express or implied warranty. In no event will """ + _HOLDER + r""" be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

""" + _ITEM + r""" The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an [[acknowledgment|acknowledgement]] in the product
documentation would be appreciated but is not required.
""" + _ITEM + r""" Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.
""" + _ITEM + r""" This notice may not be removed or altered from any source distribution.
"""

_BSD_TWO = r"""
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
""" + _ITEM + r""" Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.
""" + _ITEM + r""" Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_THIRD = _ITEM + r""" Neither the name of """ + _HOLDER + r""" nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""

_BSD_DISCLAIMER = r"""
THIS SOFTWARE IS PROVIDED BY """ + _HOLDER + r""" "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL """ + _HOLDER + r""" BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE.
"""

_APACHE_NOTICE = r"""
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this [[file|work|software]] except in
compliance with the License. You may obtain a copy of the License at

    [[http|https]]://[[www.]]apache.org/licenses/LICENSE-2.0[[.txt|.html]]

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.
"""

WHOLE: tuple[tuple[str, str], ...] = (
    ("mit-whole", _MIT),
    ("isc-whole", _ISC),
    ("zlib-whole", _ZLIB),
    ("bsd-2-clause-whole", _BSD_TWO + _BSD_DISCLAIMER),
    ("bsd-3-clause-whole", _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER),
    ("apache-2.0-notice", _APACHE_NOTICE),
)
