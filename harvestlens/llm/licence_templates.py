"""Licence templates and base phrases."""

from __future__ import annotations

# Phrases whose places are counted, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence wording (label, text, mandatory key phrases). Several
# templates may carry one label: the full notice and the one-line grant.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
     software and associated documentation files (the "Software"), to deal in the Software without
     restriction, including without limitation the rights to use, copy, modify, merge, publish,
     distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
     Software is furnished to do so, subject to the following conditions: The above copyright notice
     and this permission notice shall be included in all copies or substantial portions of the
     Software.""",
     ["permission is hereby granted", "to deal in the software without restriction"]),
    ("mit", "Released under the MIT License.", ["released under the mit license"]),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
     this file except in compliance with the License. You may obtain a copy of the License at
     http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in
     writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
     WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
     ["apache license version 2 0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.",
     ["licensed under the apache license version 2 0"]),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the
     terms of the GNU General Public License as published by the Free Software Foundation, either
     version 3 of the License, or (at your option) any later version. This program is distributed in
     the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
     MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
     ["gnu general public license", "version 3 of the license"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.",
     ["gnu general public license version 3"]),
    ("bsd-3-clause", """Redistribution and use in source and binary forms, with or without
     modification, are permitted provided that the following conditions are met: Redistributions of
     source code must retain the above copyright notice, this list of conditions and the following
     disclaimer. Neither the name of the copyright holder nor the names of its contributors may be
     used to endorse or promote products derived from this software without specific prior written
     permission.""",
     ["redistribution and use in source and binary forms", "neither the name of"]),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with
     or without fee is hereby granted, provided that the above copyright notice and this permission
     notice appear in all copies.""",
     ["for any purpose with or without fee is hereby granted"]),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
     If a copy of the MPL was not distributed with this file, You can obtain one at
     http://mozilla.org/MPL/2.0/.""",
     ["mozilla public license v 2 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ["cc by nc 4 0"]),
    ("cc-by-nc-4.0", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
     International License.""", ["creative commons attribution noncommercial 4 0"]),
    ("cc-by-4.0", """This work is licensed under a Creative Commons Attribution 4.0 International
     License.""", ["creative commons attribution 4 0 international"]),
    ("all-rights-reserved", "All rights reserved.", ["all rights reserved"]),
    ("gpl-2.0", """This program is free software; you can redistribute it and/or modify it under the
     terms of the GNU General Public License as published by the Free Software Foundation; either
     version 2 of the License, or (at your option) any later version.""",
     ["gnu general public license", "version 2 of the license"]),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2.",
     ["gnu general public license version 2"]),
    ("lgpl-2.1", """This library is free software; you can redistribute it and/or modify it under the
     terms of the GNU Lesser General Public License as published by the Free Software Foundation;
     either version 2.1 of the License, or (at your option) any later version.""",
     ["gnu lesser general public license", "version 2 1 of the license"]),
    ("lgpl-3.0", """This library is free software: you can redistribute it and/or modify it under the
     terms of the GNU Lesser General Public License as published by the Free Software Foundation,
     either version 3 of the License, or (at your option) any later version.""",
     ["gnu lesser general public license", "version 3 of the license"]),
    ("lgpl-3.0", "Licensed under the GNU Lesser General Public License, version 3.",
     ["gnu lesser general public license version 3"]),
    ("agpl-3.0", """This program is free software: you can redistribute it and/or modify it under the
     terms of the GNU Affero General Public License as published by the Free Software Foundation,
     either version 3 of the License, or (at your option) any later version.""",
     ["gnu affero general public license", "version 3 of the license"]),
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3.",
     ["gnu affero general public license version 3"]),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without
     modification, are permitted provided that the following conditions are met: Redistributions of
     source code must retain the above copyright notice, this list of conditions and the following
     disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list
     of conditions and the following disclaimer in the documentation and/or other materials provided
     with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
     """,
     ["redistributions in binary form must reproduce the above copyright notice",
      "with the distribution this software is provided by the copyright holders and contributors as is"]),
    ("bsd-2-clause", "Released under the BSD 2-Clause License.", ["bsd 2 clause license"]),
    ("bsd-3-clause", "Released under the BSD 3-Clause License.", ["bsd 3 clause license"]),
    ("isc", "Released under the ISC License.", ["isc license"]),
    ("mpl-2.0", "Licensed under the Mozilla Public License, version 2.0.",
     ["mozilla public license version 2 0"]),
    ("epl-2.0", """This program and the accompanying materials are made available under the terms of
     the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
     ["eclipse public license 2 0"]),
    ("epl-1.0", """This program and the accompanying materials are made available under the terms of
     the Eclipse Public License v1.0""", ["eclipse public license v1 0"]),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is
     free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
     code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
     means.""", ["free and unencumbered software released into the public domain"]),
    ("cc0-1.0", """To the extent possible under law, the author has waived all copyright and related or
     neighboring rights to this work.""", ["waived all copyright and related or neighboring rights"]),
    ("cc0-1.0", "Licensed under CC0 1.0 Universal.", ["cc0 1 0 universal"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0.", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ["cc by sa 4 0"]),
    ("cc-by-sa-4.0", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0
     International License.""", ["creative commons attribution sharealike 4 0"]),
    ("cc-by-sa-3.0", "Licensed under CC BY-SA 3.0.", ["cc by sa 3 0"]),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0.", ["cc by nd 4 0"]),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0.", ["cc by nc sa 4 0"]),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0.", ["cc by nc nd 4 0"]),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event
     will the authors be held liable for any damages arising from the use of this software.
     Permission is granted to anyone to use this software for any purpose, including commercial
     applications, and to alter it and redistribute it freely""",
     ["in no event will the authors be held liable", "alter it and redistribute it freely"]),
    ("bsl-1.0", """Distributed under the Boost Software License, Version 1.0. (See accompanying file
     LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)""",
     ["boost software license version 1 0"]),
    ("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", ["you want to public license"]),
    ("artistic-2.0", """You may distribute this package under the terms of the Artistic License 2.0""",
     ["artistic license 2 0"]),
    ("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
     ["sil open font license version 1 1"]),
    ("eupl-1.2", "Licensed under the EUPL, Version 1.2", ["licensed under the eupl version 1 2"]),
    ("cddl-1.0", """The contents of this file are subject to the terms of the Common Development and
     Distribution License (the "License").""", ["common development and distribution license"]),
    ("odbl-1.0", """This database is made available under the Open Database License""",
     ["open database license"]),
    ("ms-pl", "Licensed under the Microsoft Public License (MS-PL).", ["microsoft public license"]),
    ("postgresql", "Released under the PostgreSQL License.", ["postgresql license"]),
    ("psf-2.0", "Licensed under the Python Software Foundation License, version 2.",
     ["python software foundation license"]),
]
