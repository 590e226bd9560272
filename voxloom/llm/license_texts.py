"""Fixed values of the licence scan: wording of licences and notices, by family."""

from __future__ import annotations

# fixed values: paragraphs of licences and the notices that refer to them
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GPL version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License.",
        "Licensed under the LGPL version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nc-sa": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "cc0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}
# fixed values: names that are a notice where they are all of a line, by family
NAMES = {
    "apache-2.0": ("Apache License", "Apache License 2.0", "Apache License, Version 2.0", "Apache-2.0 License"),
    "mit": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "isc": ("ISC License", "The ISC License"),
    "gpl-3.0": ("GNU General Public License v3.0", "GNU General Public License, version 3", "GPL-3.0 License"),
    "gpl-2.0": ("GNU General Public License v2.0", "GNU General Public License, version 2", "GPL-2.0 License"),
    "lgpl": ("GNU Lesser General Public License", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License v3.0"),
    "agpl-3.0": ("GNU Affero General Public License", "GNU Affero General Public License v3.0"),
    "bsd": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'),
    "mpl-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0"),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0 International"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    "cc-by-nc-sa": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    "cc0": ("CC0 1.0 Universal",),
}
# fixed values: SPDX identifiers without their endings (-only, -or-later, +), lower case, as patterns, by family
SPDX = {
    "apache-2.0": r"apache-2\.0",
    "mit": r"mit|mit-0",
    "isc": r"isc",
    "gpl-3.0": r"gpl-3\.0",
    "gpl-2.0": r"gpl-2\.0",
    "lgpl": r"lgpl-[23]\.[01]",
    "agpl-3.0": r"agpl-3\.0",
    "bsd": r"bsd-[123]-clause",
    "mpl-2.0": r"mpl-2\.0",
    "cc-by": r"cc-by-[1-4]\.[05]",
    "cc-by-sa": r"cc-by-sa-[1-4]\.[05]",
    "cc-by-nc": r"cc-by-nc-[1-4]\.[05]",
    "cc-by-nc-sa": r"cc-by-nc-sa-[1-4]\.[05]",
    "cc0": r"cc0-1\.0",
}
# fixed values: paragraphs that have words of licences and license nothing
NEAR_MISSES = (
    "The driver's license expired last year.",
    "She lost her fishing license at the lake.",
    "The licence fee rose again.",
    "A copyright dispute was settled in court.",
    "The warranty covers two years of use.",
    "He asked permission to leave the room.",
    "The police took the license plate number.",
    "Public domain names are sold at auction.",
    "The pilot was licensed in March.",
    "She studied at MIT for four years.",
    "Version 2.0 of the report was published.",
    "The apache helicopter landed on the field.",
    "The software version 3 is out now.",
    "Public transport in general was free.",
    "The rights of the people were reserved for later talks.",
    "Poetic license was taken with the facts.",
    "Licensed software is listed in the appendix of this report.",
    "The terms of the agreement were published in the following week.",
    "The foundation published a free version of the program for schools.",
    "Any person may obtain a copy of the map at the office.",
)
# fixed values: other wordings, which no training row holds; the curve of probabilities is fitted on them
OTHER_WORDINGS = {
    "apache-2.0": ("The project is distributed under the Apache License 2.0.", "This file is licensed to you under the Apache License, Version 2.0."),
    "mit": ("This project is available under the MIT license.", "The code is MIT licensed, see the MIT License for details."),
    "isc": ("This package is released under the ISC license.",),
    "gpl-3.0": ("Distributed under the GNU General Public License version 3.", "This file is covered by the GNU GPL, version 3."),
    "gpl-2.0": ("Distributed under the GNU General Public License version 2.", "This file is covered by the GNU GPL, version 2."),
    "lgpl": ("The library is distributed under the GNU Lesser General Public License, version 2.1.",),
    "agpl-3.0": ("Distributed under the GNU Affero General Public License version 3.",),
    "bsd": ("This code is available under the BSD 3-Clause license.", "Distributed under a BSD 2-Clause License."),
    "mpl-2.0": ("Distributed under the Mozilla Public License 2.0.",),
    "cc-by": ("The text is available under CC BY 4.0.",),
    "cc-by-sa": ("The text is available under CC BY-SA 4.0.",),
    "cc-by-nc": ("The text is available under CC BY-NC 4.0.",),
    "cc-by-nc-sa": ("The text is available under CC BY-NC-SA 4.0.",),
    "cc0": ("The data are released under CC0 1.0 Universal.",),
    "all-rights-reserved": ("Copyright 2020 by the author, all rights reserved.",),
    "unknown": (
        "The bar lost its liquor license after the fire.",
        "The museum holds the copyright of the letters.",
        "Version 3 of the public plan was licensed by the general.",
        "All seats at the front are reserved.",
        "The creative commons of the village was sold.",
        "The software was distributed to all schools.",
        "A copy of the notice was sent to the author.",
        "The conditions of the warranty were modified in May.",
    ),
}
