"""Texts of public license notices: (label, name, text).  Fixed values."""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
    "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
    "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version."
)
_GPL_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."

TEMPLATES = (
    ("gpl", "gpl-notice", _GPL),
    ("gpl", "gpl-full-notice", f"{_GPL} {_GPL_WARRANTY}"),
    ("gpl", "gpl-short", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "lgpl-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "agpl-notice", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "apache-full-notice", _APACHE),
    ("apache", "apache-notice", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache", "apache-short", "Licensed under the Apache License, Version 2.0"),
    ("mit", "mit-text", f"{_MIT_GRANT} {_MIT_NOTICE} {_MIT_WARRANTY}"),
    ("mit", "mit-grant", _MIT_GRANT),
    ("mit", "mit-opening", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "mit-short", "Released under the MIT License"),
    ("bsd", "bsd-3-text", f"{_BSD_GRANT} {_BSD_CLAUSES} {_BSD_THIRD} {_BSD_WARRANTY}"),
    ("bsd", "bsd-2-text", f"{_BSD_GRANT} {_BSD_CLAUSES} {_BSD_WARRANTY}"),
    ("bsd", "bsd-grant", _BSD_GRANT),
    ("isc", "isc-text", f"{_ISC_GRANT} {_ISC_WARRANTY}"),
    ("isc", "isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "zlib-grant", _ZLIB),
    ("mpl", "mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "cc-by-nc-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "cc-by-nc-short", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "cc-by-sa-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "cc-by-sa-short", "Licensed under CC BY-SA 4.0"),
    ("cc0", "cc0-notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "unlicense-text", _UNLICENSE),
    ("unlicense", "unlicense-opening", "This is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all-rights-reserved", "All rights reserved"),
)
