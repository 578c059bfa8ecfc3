"""Training texts of the licence classifier."""

# Notices and key sentences of common licences, by family; short ones and SPDX lines last.
TEMPLATES = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "GNU Affero General Public License v3.0",
        "GNU AGPL version 3",
        "Licensed under AGPL-3.0",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "Apache License 2.0",
        "Apache License, Version 2.0",
        "Licensed under Apache 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "BSD License",
        "BSD 2-Clause License",
        "BSD 3-Clause License",
        "Licensed under BSD",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "CC BY 4.0",
        "Creative Commons Attribution 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "CC0 1.0",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU General Public License v3.0",
        "GNU GPL version 3",
        "Licensed under GPL-3.0",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "ISC License",
        "Licensed under ISC",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "You should have received a copy of the GNU Lesser General Public License along with this program.",
        "GNU Lesser General Public License v3.0",
        "GNU LGPL version 3",
        "Licensed under LGPL-3.0",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "MIT License",
        "The MIT License (MIT)",
        "Licensed under MIT",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "Released under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License 2.0",
        "Licensed under MPL 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This document is confidential and proprietary and may not be copied or disclosed.",
        "All rights reserved.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "The Unlicense",
        "Released under the Unlicense",
        "SPDX-License-Identifier: Unlicense",
    ],
}

# Own sentences that use the same words and grant nothing.
OTHER = """
The driver lost his license after the accident.
A fishing license is required on this part of the river.
The band released a new album under the title Version 3.
Researchers at MIT published the results last spring.
The general public was invited to the opening.
Apache helicopters flew over the town.
The software crashed twice on the first day.
Permission to build the house was granted by the town council.
Copies of the report can be found in the library.
She works for a free newspaper as a copy editor.
The foundation supports public schools with books.
A copy of the letter was sent to the mayor.
The terms of the contract were not published.
The museum is open to the public free of charge.
He asked for written permission to leave early.
The author of this work lived in Lisbon.
All rights and duties of members are listed in the statutes.
Their international creative team won a common prize.
The file holds the names of the contributors.
This program of concerts ends in May.
The law applies to every domain of public life.
Redistribution of income was the topic of the debate.
The source of the river lies in the mountains.
The first version of the plan was rejected.
Under the bridge there is a small café.
You may use the garden in the morning.
The conditions were met by only two candidates.
The club is licensed to serve wine.
Mozilla is not mentioned in the article.
The commercial was shown without sound.
Attribution of the painting to Rembrandt is doubtful.
The work was released in three parts.
This document lists all streets of the town.
Confidential talks went on until midnight.
This library has no coffee machine.
Warranty claims must reach the shop within two years.
The public domain of the port belongs to the state.
The copyright office moved to a new building.
Any person over eighteen may join.
The share of rain that falls in winter is small.
All rights were sold to a publisher.
The rights of the members are reserved for later.
A table was reserved for all guests.
Version 2.0
Version 3
The license
The software
In the public domain of ideas nothing is free.
Students of the MIT came by bus.
The author and the copyright of the song are unknown.
"""
