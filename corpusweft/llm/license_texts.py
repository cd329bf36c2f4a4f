"""Words of public license texts and notices, by paragraph: the default templates of the license scan.

A template is (label, text). Long texts are given by paragraph, as excerpts are common.
"""

_MIT = [
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal "
    "in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness "
    "for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
    "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "released under the mit license",
    "licensed under the mit license",
]
_BSD = [
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or "
    "other materials provided with the distribution",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
    "specific prior written permission",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use "
    "data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or "
    "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
]
_ISC = [
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
    "notice and this permission notice appear in all copies",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability "
    "and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of "
    "use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
]
_APACHE = [
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
    "conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free "
    "irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative "
    "works in source or object form",
]
_GNU = "this {0} is free software you can redistribute it and or modify " "it under the terms of the gnu {1} general public license as published by the free software foundation"
_GNU_HOPE = "this {0} is distributed in the hope that it will be useful " "but without any warranty without even the implied warranty of merchantability " "or fitness for a particular purpose see the gnu {1} general public license for more details"


def _gnu(thing: str, kind: str) -> list[str]:
    return [" ".join(x.format(thing, kind).split()) for x in (_GNU, _GNU_HOPE)]


_GPL = [*_gnu("program", ""), "this work is licensed under the gnu general public license version 3", "under the terms of the gnu general public license version 2"]
_LGPL = [*_gnu("library", "lesser"), "under the terms of the gnu lesser general public license"]
_AGPL = [*_gnu("program", "affero"), "under the terms of the gnu affero general public license"]
_MPL = [
    "this source code form is subject to the terms of the mozilla public license v 2 0",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
]
_EPL = ["this program and the accompanying materials are made available under the terms of the eclipse public license which accompanies this distribution"]
_ZLIB = [
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an "
    "acknowledgment in the product documentation would be appreciated but is not required",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
]
_UNLICENSE = [
    "this is free and unencumbered software released into the public domain",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
    "commercial or non commercial and by any means",
    "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain",
]
_BOOST = [
    "distributed under the boost software license version 1 0",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this "
    "license to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
]
_CC = {
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc-by-nc-sa": ["licensed under cc by nc sa 4 0", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"],
    "cc-by-nc-nd": ["licensed under cc by nc nd 4 0", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
}
_RESERVED = ["copyright all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means without the prior written permission of the publisher"]

_ALL = {
    "mit": _MIT, "bsd": _BSD, "isc": _ISC, "apache-2.0": _APACHE, "gpl": _GPL, "lgpl": _LGPL, "agpl": _AGPL, "mpl-2.0": _MPL, "epl": _EPL,
    "zlib": _ZLIB, "unlicense": _UNLICENSE, "bsl-1.0": _BOOST, **_CC, "reserved": _RESERVED,
}
TEMPLATES: list[tuple[str, str]] = [(label, text) for label, texts in _ALL.items() for text in texts]
