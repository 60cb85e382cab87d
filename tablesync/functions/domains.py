"""Free e-mail domains that stay visible after masking.

Fixed values: the published tables depend on exactly this list, typing errors and
all. Two entries hold capitals and can therefore never equal a lower-cased domain;
one ends in a space.
"""

FREE_DOMAINS = (
    "aol.com", "bigpond.com", "bigpond.net.id", "bluewin.ch", "blueyonder.co.id", "bol.com",
    "centurytel.net", "charter.net", "chello.com", "club-internet.com", "comcast.net", "comee.com",
    "comeenet.net", "comontiernet.net", "cox.net", "earthlink.net", "facebook.com",
    "gmail.com", "gmail.co.id", "gmail.con", "gmal.com", "gmx.co.id", "gmx.net", "gmx.com",
    "gmx.de", "googlemail.com", "hetnet.co.id", "home.co.id", "hotmail.co.id",
    "hotmail.com", "hotmail.cim", "juno.com", "laposte.net", "live.co.id", "live.com",
    "mac.com", "mail.com", "mail.ru", "me.com", "msn.com", "neuf.com", "ntlworld.com",
    "optonline.net", "optusnet.com", "orange.com", "outlook.com", "outlook.co.id",
    "planet.co.id", "qq.com", "rambler.co.id", "rediffmail.com", "rocketmail.com",
    "sbcglobal.net", "scom.com", "shaw.ca", "sky.com", "skynet.be", "sympatico.ca",
    "telenet.co.id", "terra.com.br", "tuta.io", "verizon.net", "voila.com",
    "wanadoo.com", "windstream.net", "yahoo.co.id", "yahoo.com", "ymail.com",
    "ymail.co.id", "icloud.com", "windowslive.com", "mailinator.cok", "mailinator.com",
    "gmaul.com", "gmai.com", "gmail.conm", "gmail.coma", "outlool.com", "yaoo.com",
    "gmail.co", "gemail.com", "gmakl.com", "gail.com", "gmail.cm", "gmail.coim", "gamil.com",
    "gmil.com", "gmailm.com", "yahoo.cm", "gmali.com", "yahoo.id", "yahoo.ckm", "gmail.cok",
    "yahoo.con.id", "gimel.com", "gmain.com", "gmail.xcom", "gmaip.com", "gmaol.com", "gmaill.com",
    "yahoo.co.od", "yahoo.om", "gmsil.com", "gmail.com.2", "yahoo.co.uk", "yhoo.com", "yahoo.com.au",
    "3578gmail.com", "53gmail.com", "697gmeil.com", "fmail.com", "g.mail.com", "gimail.com", "gmai.l.com",
    "gmai.lcom", "gmaiil.com", "gmaik.com", "gmaikl.com", "gmail.clm", "gmail.co.uk", "gmail.com (Non Aktif)",
    "gmail.com ", "gmail.com.el", "g-mail.com.id", "gmail.com081218", "gmail.com3", "gmail.comArjan",
    "gmail.cpm", "gmail.fom", "gmail.om", "gmail.som", "gmail.vom", "gmail.xom", "gmail1.com", "gmail12.com",
    "gmail88.com", "gmaio.com", "gmal.nom", "gmeil.com", "gmel.com", "gmial.com", "gmile.com", "gmli.com",
    "hmail.com", "iclod.com", "icloid.com", "icloud.id", "paper.com", "paper.id2", "paper.idd", "paper.ids",
    "paper2.id", "tes.com", "tesk.com", "test.com", "test.id", "test3.com", "testajaa.com", "tested.com",
    "testing.com", "testingpaper.ic", "testtt.com", "testuser.com", "xxx.com", "y7mail.com", "yaho.co.id",
    "yaho.com", "yahoo.co.if", "yahoo.co.is", "yahoo.cok", "yahoo.com.id", "yahoo.com.tw", "yahoo.fr",
    "yahoo.id.co", "yahoo.xom", "yahool.com", "yahooo.com", "yhoo.co.id", "ymail.cim", "yahoi.com",
    "yahoo.con", "gmail.cim", "paper.id",
)
