"""Sentences of license texts and of the headers that files carry.

Each is a rule of its own beside those that ``licenses`` makes of names: it finds a license that is pasted without its
name. They are written over words as ``licenses`` sees them: lower case, parted by single spaces, without punctuation.
"""

# Label, keyword, and the sentence as a regular expression that holds the keyword.
SIGNATURES = [
    # Short permissive licenses.
    ("mit", "obtaining a copy of this software", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial portions of the software", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "to deal in the software", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell"),
    ("ncsa", "to deal with the software", r"to deal with the software without restriction including without limitation the rights to use copy modify merge publish"),
    ("ncsa", "nor the names of its contributors may be used", r"neither the names of (?:\S+ ){1,20}nor the names of its contributors may be used to endorse or promote products derived from this software without specific"),
    ("x11", "used in advertising or otherwise to promote", r"except as contained in this notice the name of (?:\S+ ){1,12}shall not be used in advertising or otherwise to promote the sale use or other dealings"),
    ("json", "for good not evil", r"the software shall be used for good not evil"),
    ("isc", "with or without fee is hereby granted provided", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "with or without fee is hereby granted", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("hpnd", "this software and its documentation", r"permission to use copy modify and (?:or )?(?:distribute|sell) this software and its documentation for any purpose"),
    ("hpnd", "no representations about the suitability", r"makes? no representations about the suitability of this software for any purpose"),
    ("beerware", "buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("fsf-ap", "medium without royalty", r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("blueoak-1.0.0", "from you with or without changes also gets", r"everyone who gets a copy of any part of this software from you with or without changes also gets the text of this license"),
    # BSD family.
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-2-clause", "materials provided with the distribution this software", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by"),
    ("bsd-3-clause", "to endorse or promote products derived from this software", r"neither the name of (?:\S+ ){1,20}nor the names of (?:its|their) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "may not be used to endorse or promote", r"the names? of the (?:author|copyright holder|contributors?)s? may not be used to endorse or promote products derived from this software"),
    ("bsd-3-clause-clear", "no express or implied licenses to any party s patent", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-4-clause", "all advertising materials mentioning features", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-source-code", "neither the name of", r"redistributions of source code must retain the above copyright notice (?:\S+ ){1,10}neither the name of"),
    # Apache.
    ("apache-2.0", "except in compliance with the license", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "terms and conditions for use reproduction and distribution", r"terms and conditions for use reproduction and distribution 1 definitions"),
    ("apache-2.0", "irrevocable copyright license to reproduce", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce"),
    ("apache-2.0", "irrevocable except as stated in this section patent license", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license"),
    ("apache-2.0", "recipients of the work or derivative works", r"you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache-2.0", "carry prominent notices stating that you changed", r"you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache-2.0", "institute patent litigation against any entity", r"if you institute patent litigation against any entity including a cross claim or counterclaim in a lawsuit"),
    ("apache-1.1", "apache appear in their name", r"products derived from this software may not be called apache nor may apache appear in their name"),
    ("apache-1.1", "developed by the apache software foundation", r"this product includes software developed by the apache software foundation"),
    # GNU: headers.
    ("gpl", "this program is free software", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", "is free software you can redistribute it", r"(?:this file|this software|\S+) is free software you can redistribute it and or modify it"),
    ("gpl-2.0", "either version 2 of the license", r"published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-2.0", "version 2 as published by the free software foundation", r"version 2 as published by the free software foundation"),
    ("gpl-3.0", "either version 3 of the license", r"published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-3.0", "version 3 as published by the free software foundation", r"version 3 as published by the free software foundation"),
    ("lgpl", "this library is free software", r"this library is free software you can redistribute it and or modify it"),
    ("lgpl-2.1", "either version 2 1 of the license", r"published by the free software foundation either version 2 1 of the license"),
    # GNU: bodies.
    ("gpl-2.0", "licenses for most software are designed", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-2.0", "mere aggregation of another work", r"mere aggregation of another work not based on the program with the program or with a work based on the program"),
    ("gpl-2.0", "act of running the program is not restricted", r"the act of running the program is not restricted and the output from the program is covered only if its contents constitute a work based on the program"),
    ("gpl-3.0", "licenses for most software and other practical works", r"the licenses for most software and other practical works are designed to take away your freedom to share and change the works"),
    ("gpl-3.0", "convey verbatim copies of the program", r"you may convey verbatim copies of the program s source code as you receive it in any medium"),
    ("gpl-3.0", "no covered work shall be deemed part", r"no covered work shall be deemed part of an effective technological measure"),
    ("gpl-3.0", "granted for the term of copyright on the program", r"all rights granted under this license are granted for the term of copyright on the program and are irrevocable"),
    ("lgpl-2.1", "no derivative of any portion of the library", r"a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("lgpl-3.0", "application is any work that makes use of an interface", r"an application is any work that makes use of an interface provided by the library"),
    ("lgpl-3.0", "supplemented by the additional permissions", r"incorporates the terms and conditions of version 3 of (?:\S+ ){1,10}supplemented by the additional permissions listed below"),
    ("agpl-3.0", "interacting with it remotely through a computer network", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "no invariant sections", r"with no invariant sections (?:with )?no front cover texts and (?:with )?no back cover texts"),
    ("gfdl", "copy distribute and or modify this document", r"permission is granted to copy distribute and or modify this document under the terms of"),
    # Weak copyleft.
    ("mpl-2.0", "this source code form is subject to the terms", r"this source code form is subject to the terms of"),
    ("mpl-2.0", "covered software is provided under this license", r"covered software is provided under this license on an as is basis without warranty of any kind"),
    ("mpl-2.0", "incompatible with secondary licenses", r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", "language governing rights and limitations under the license", r"either express or implied see the license for the specific language governing rights and limitations under the license"),
    ("mpl-1.1", "initial developer hereby grants you", r"the initial developer hereby grants you a world wide royalty free non exclusive license subject to third party intellectual property claims"),
    ("cddl-1.0", "conditioned upon your compliance with section 3 1", r"conditioned upon your compliance with section 3 1 below and subject to third party intellectual property claims the initial developer"),
    ("epl-1.0", "recipient s acceptance of this agreement", r"the accompanying program is provided under the terms of this (?:\S+ ){0,3}public license agreement any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement"),
    ("epl-2.0", "available under the following secondary licenses", r"this source code may also be made available under the following secondary licenses when the conditions for such availability"),
    ("ms-pl", "your patent license from such contributor", r"if you bring a patent claim against any contributor over patents that you claim are infringed by the software your patent license from such contributor"),
    ("ms-rl", "reciprocal grants", r"reciprocal grants for any file you distribute that contains code from the software"),
    ("eupl-1.2", "worldwide royalty free non exclusive sublicensable licence", r"the licensor hereby grants you a worldwide royalty free non exclusive sublicensable licence"),
    ("osl-3.0", "external deployment means the use", r"external deployment means the use distribution or communication of the original work or derivative works in any way such that"),
    ("artistic", "conditions under which a package may be copied", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", "terms under which a given free software package", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("ruby", "duplicate all of the original copyright notices", r"you may make and give away verbatim copies of the source form of the software without restriction provided that you duplicate all of the original copyright notices"),
    # Zlib, Boost and other named permissive ones.
    ("zlib", "origin of this software must not be misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions must be plainly marked", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "contributing authors", r"the contributing authors and (?:\S+ ){1,6}disclaim all warranties expressed or implied"),
    ("bsl-1.0", "person or organization obtaining a copy of the software", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsl-1.0", "solely in the form of machine executable object code", r"unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("openssl", "developed by the openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php-3.01", "php appear in their name", r"products derived from this software may not be called php nor may php appear in their name"),
    ("psf-2.0", "psf hereby grants licensee", r"subject to the terms and conditions of this license agreement psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("psf-2.0", "psf is making python available", r"psf is making python available to licensee on an as is basis"),
    ("w3c", "other related items is being provided", r"this work (?:and|including software documents or) other related items is being provided by the copyright holders?"),
    ("unicode", "data files and any associated documentation", r"permission is hereby granted free of charge to any person obtaining a copy of the (?:unicode )?data files and any associated documentation"),
    ("upl-1.0", "freely licensable by each licensor hereunder", r"copyright and patent rights owned or freely licensable by each licensor hereunder covering either"),
    ("afl-3.0", "academic free", r"licensed under the academic free license"),
    ("postgresql", "without a written agreement is hereby granted", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    # Giving up rights.
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "dedicate any and all copyright interest", r"dedicate any and all copyright interest in the software to the public domain"),
    ("wtfpl", "do what the fuck you want to", r"do what the fuck you want to"),
    ("wtfpl", "as long as the name is changed", r"copies of this license document and changing it is allowed as long as the name is changed"),
    ("cc0-1.0", "has dedicated the work to the public domain", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1.0", "affirmer hereby overtly fully permanently", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
    ("cc0-1.0", "has waived all copyright and related", r"to the extent possible under law (?:\S+ ){1,12}has waived all copyright and related or neighboring rights"),
    ("pddl-1.0", "rightsholder", r"the rightsholder permanently and irrevocably makes the work available to the public for any use of any kind"),
    # Creative Commons and open data.
    ("cc-by", "give appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", "under the same license as the original", r"if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("cc-by-nc", "use the material for commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-by-nd", "may not distribute the modified material", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc-by-4.0", "exercise the licensed rights in the licensed material", r"royalty free non sublicensable non exclusive irrevocable license to exercise the licensed rights in the licensed material to"),
    ("odbl-1.0", "offer that adapted database", r"you must also offer that adapted database under"),
    ("ofl-1.1", "fonts and derivatives however cannot be released", r"the fonts and derivatives however cannot be released under any other type of license"),
    ("ofl-1.1", "stimulate worldwide development of collaborative font projects", r"are to stimulate worldwide development of collaborative font projects"),
    ("ofl-1.1", "neither the font software nor any of its individual components", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    # Source available and model licenses.
    ("busl-1.1", "make non production use of the licensed work", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("busl-1.1", "first publicly available distribution", r"effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("sspl-1.0", "functionality of the program or a modified version available", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", "hosted or managed service", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "right to sell the software", r"the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("polyform-noncommercial", "any noncommercial purpose is a permitted purpose", r"any noncommercial purpose is a permitted purpose"),
    ("openrail", "use the model or derivatives of the model", r"you agree not to use the model or derivatives of the model"),
    ("proprietary", "confidential and proprietary", r"this (?:software|source code|file) is (?:the )?confidential and proprietary"),
    ("proprietary", "unauthorized copying of this file", r"unauthorized copying of this file via any medium is strictly prohibited"),
]

#: Every sentence above has a word outside of its groups that begins with one of these.
STEMS = ("permission", "permitted", "redistribut", "warrant", "copyright", "misrepresent", "derivative", "evil", "beer", "fuck", "royalty", "advertising",
         "prominent", "litigation", "aggregation", "constitute", "verbatim", "technological", "interface", "invariant", "subject", "conditioned", "package",
         "affirmer", "patent", "foundation", "deployment", "remix", "merchant", "commercial", "database", "unauthorized", "confidential", "acknowledg",
         "endorse", "hereby", "remotely", "reciprocal", "individual", "worldwide", "appropriate", "suitability", "definitions", "derived", "openssl", "compile", "functionality", "managed",
         "licens", "licenc", "public", "publish", "rights", "proprietary")
