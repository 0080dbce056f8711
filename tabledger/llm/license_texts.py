"""Phrases of the base scan, and licence templates.

Templates are wording in lower case without punctuation. ``<<optional>> ... <<end>>``
may be left out; ``<<any:n>>`` stands for up to n words of any kind.
"""

PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_COPYRIGHT = "<<optional>> copyright <<any:25>> <<end>> <<optional>> all rights reserved <<end>>"
_BSD_OPEN = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met <<optional>> 1 <<end>> redistributions of source code must retain the above copyright"
    " notice this list of conditions and the following disclaimer <<optional>> 2 <<end>> redistributions in binary form must"
    " reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or"
    " other materials provided with the distribution"
)
_BSD_CLOSE = (
    "this software is provided by <<any:12>> as is and any express or implied warranties including but not limited to the"
    " implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<any:12>>"
    " be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to"
    " procurement of substitute goods or services loss of use data or profits or business interruption however caused and on"
    " any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any"
    " way out of the use of this software even if advised of the possibility of such damage"
)

TEMPLATES = (
    ("mit", "mit-text", f"<<optional>> <<optional>> the <<end>> mit license <<end>> {_COPYRIGHT}"
     " permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
     " documentation files the software to deal in the software without restriction including without limitation the rights"
     " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to"
     " whom the software is furnished to do so subject to the following conditions the above copyright notice and this"
     " permission notice <<optional>> including the next paragraph <<end>> shall be included in all copies or substantial"
     " portions of the software the software is provided as is without warranty of any kind express or implied including but"
     " not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event"
     " shall <<any:8>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise"
     " arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "isc-text", f"<<optional>> isc license <<end>> {_COPYRIGHT}"
     " permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
     " provided that the above copyright notice and this permission notice appear in all copies the software is provided as"
     " is and <<any:6>> disclaims all warranties with regard to this software including all implied warranties of"
     " merchantability and fitness in no event shall <<any:6>> be liable for any special direct indirect or consequential"
     " damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract"
     " negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("bsd-2-clause", "bsd-2-text", f"{_COPYRIGHT} {_BSD_OPEN} {_BSD_CLOSE}"),
    ("bsd-3-clause", "bsd-3-text", f"{_COPYRIGHT} {_BSD_OPEN} <<optional>> 3 <<end>> neither the name of <<any:12>> nor the"
     " names of its contributors may be used to endorse or promote products derived from this software without specific"
     f" prior written permission {_BSD_CLOSE}"),
    ("apache-2", "apache-2-header", f"{_COPYRIGHT}"
     " licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
     " license you may obtain a copy of the license at <<optional>> http <<end>> <<optional>> https <<end>> www apache org"
     " licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license"
     " is distributed on an as is basis without warranties or conditions of any kind either express or implied see the"
     " license for the specific language governing permissions and limitations under the license"),
    ("apache-2", "apache-2-notice", "<<optional>> this <<any:2>> is <<end>> <<optional>> released <<end>> <<optional>> licensed"
     " <<end>> under the apache license version 2 <<optional>> 0 <<end>>"),
    ("mit", "mit-notice", "<<optional>> this <<any:2>> is <<end>> <<optional>> released <<end>> <<optional>> licensed <<end>>"
     " under the <<optional>> terms of the <<end>> mit license"),
    ("gpl-3", "gpl-3-notice", "<<optional>> this <<any:2>> is <<end>> licensed under the gnu general public license version 3"),
    ("gpl-2", "gpl-2-notice", "<<optional>> this <<any:2>> is <<end>> licensed under the gnu general public license version 2"),
    ("gpl", "gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu"
     " general public license as published by the free software foundation either version <<any:1>> of the license or at your"
     " option any later version"),
    ("lgpl", "lgpl-notice", "<<optional>> this <<any:2>> is <<end>> licensed under the gnu lesser general public license version"
     " <<any:2>>"),
    ("mpl-2", "mpl-2-header", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the"
     " mpl was not distributed with this file you can obtain one at <<any:1>> mozilla org mpl 2 0"),
    ("cc-by-nc", "cc-by-nc-notice", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> cc by nc <<optional>> 4 0"
     " <<end>>"),
    ("cc-by-nc", "cc-by-nc-name", "creative commons attribution noncommercial <<any:2>> license"),
    ("cc-by-sa", "cc-by-sa-notice", "licensed under <<optional>> a <<end>> <<optional>> the <<end>> cc by sa <<optional>> 4 0"
     " <<end>>"),
    ("cc-by", "cc-by-name", "creative commons attribution <<any:2>> license"),
    ("all-rights-reserved", "reserved-notice", "<<optional>> copyright <<any:8>> <<end>> all rights reserved"),
    ("unlicense", "unlicense-text", "this is free and unencumbered software released into the public domain anyone is free to"
     " copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"
     " for any purpose commercial or non commercial and by any means"),
)
