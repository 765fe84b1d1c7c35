"""Short notices and opening sentences of public licences, by family."""

TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Apache License Version 2.0, January 2004"),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program."),
    ("gpl", "Released under the GNU GPL, version 2 or later."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("lgpl", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "You can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    ("agpl", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("bsd", "Distributed under the BSD 3-Clause License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "Licensed under the Mozilla Public License, version 2.0."),
    ("mpl", "SPDX-License-Identifier: MPL-2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("cc0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("isc", "Licensed under the ISC License."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher."),
    ("proprietary", "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited."),
)

# Sentences with words of licences that are none.
OTHERS = (
    "She renewed her driving license at the office in the morning.",
    "The teacher licensed the van and drove to the general store.",
    "Members of the public may use the library free of charge.",
    "The permission of the owner is needed to enter the garden.",
    "All seats for the evening are reserved for guests.",
    "The first version of the story was published in the spring.",
    "He had the right to copy the letter but not to change the terms.",
    "The foundation gave software and books to the school without conditions.",
)
