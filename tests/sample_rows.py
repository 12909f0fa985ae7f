"""The sample rows of the source tables, pipe-delimited under their column names.

Dates are CYYMMDD numbers, an empty field is NULL. One book, one sale and one stock row carry an ISBN
whose check digit is wrong on purpose.
"""

SAMPLE = {
    "editeurs": """
EDCODE|EDNOM|EDIMPR|EDGRPE|EDPAYS|EDSTAT
GRASSET|Éditions Grasset|Grasset|GRPEDI01|FR|A
FAYARD|Librairie Arthème Fayard|Fayard|GRPEDI01|FR|A
STOCK|Éditions Stock|Stock|GRPEDI01|FR|A
CALMLVY|Calmann-Lévy|Calmann-Lévy|GRPEDI01|FR|A
LGENPOC|Le Livre de Poche|LGF|GRPEDI01|FR|A
LAFFONT|Éditions Robert Laffont|Robert Laffont|EDITIS|FR|A
GALLMRD|Éditions Gallimard|Gallimard|GALLMRD|FR|A
FLAMMRN|Flammarion|Flammarion|MADRIGALL|FR|A
""",
    "collections": """
CLCODE|CLNOM|CLEDIT|CLDTCR|CLSTAT
LITT_FR|Littérature française|GRASSET|1200101|A
LITT_ET|Littérature étrangère|GRASSET|1200101|A
DOC_FAY|Documents|FAYARD|1190501|A
ROM_STO|Romans|STOCK|1200301|A
LDP_LIT|Le Livre de Poche — Littérature|LGENPOC|1150101|A
POL_CML|Policier|CALMLVY|1180601|A
FOLIO|Folio|GALLMRD|780101|A
BLNC_GL|Blanche|GALLMRD|110101|A
""",
    "auteurs": """
AUCODE|AUNOM|AUPRN|AUPSEUD|AUNATI|AUDTNS|AUDTDC|AUEMAIL|AUDTCR|AUSTAT
AUT00001|Nothomb|Amélie||BE|660709|||1200101|A
AUT00002|Houellebecq|Michel||FR|580226|||1200101|A
AUT00003|Musso|Guillaume||FR|740628|||1200301|A
AUT00004|Lévy|Marc||FR|611016|||1200101|A
AUT00005|Gavalda|Anna||FR|701209|||1200601|A
AUT00006|Modiano|Patrick||FR|450730|||1200101|A
AUT00007|Ernaux|Annie||FR|400901|||1200101|A
AUT00008|Despentes|Virginie||FR|690613|||1200501|A
AUT00009|García Márquez|Gabriel|Gabo|CO|270306|1140417||1200101|I
AUT00010|Durand|Claude||FR|550115|||1200101|A
""",
    "ouvrages": """
OVISBN|OVTITR|OVSTIT|OVEDIT|OVCOLL|OVFMT|OVLANG|OVNBPG|OVPXHT|OVPXTTC|OVTVA|OVDTPB|OVDTCR|OVDTMJ|OVSTAT|OVTIRG|OVPOID|OVEAN|OVCOMM
9782246831471|Premier sang||GRASSET|LITT_FR|GFT|FRE|192|18.00|18.99|5.50|1211006|1210901|1250101|AC|80000|280|9782246831471|
9782080287410|Anéantir||FLAMMRN|LITT_FR|GFT|FRE|736|26.00|27.43|5.50|1220107|1211201|1250101|AC|300000|890|9782080287410|
9782702183694|L'inconnue de la Seine||CALMLVY|POL_CML|GFT|FRE|480|21.90|23.10|5.50|1220413|1220301|1250201|AC|150000|520|9782702183694|
9782221267639|C'est arrivé la nuit||LAFFONT|LITT_FR|GFT|FRE|528|22.00|23.21|5.50|1211021|1210801|1250201|AC|200000|600|9782221267639|
9782246826118|Le livre des Baltimore|Roman|GRASSET|LITT_FR|GFT|FRE|480|22.00|23.21|5.50|1150924|1150701|1250101|EP|350000|545|9782246826118|
9782253237341|Anéantir||LGENPOC|LDP_LIT|POC|FRE|736|9.40|9.92|5.50|1230209|1221201|1250101|AC|500000|380|9782253237341|
9782070368228|L'étranger||GALLMRD|FOLIO|POC|FRE|186|7.50|7.91|5.50|780301|780101|1250101|AC|10000000|120|9782070368228|
9782246834519|Psychopompe||GRASSET|LITT_FR|GFT|FRE|160|18.00|18.99|5.50|1230816|1230601|1250301|AC|100000|220|9782246834519|
9782070000000|Titre fictif test QG||GALLMRD|BLNC_GL|GFT|FRE|300|20.00|21.10|5.50|1240515|1240401|1250301|AC|5000|350|9782070000000|
9782246819523|Cent ans de solitude||GRASSET|LITT_ET|GFT|FRE|470|24.00|25.32|5.50|1070301|1060101|1250101|AC|2000000|510|9782246819523|
""",
    "ouvrages_auteurs": """
JAISBN|JAAUTE|JAROLE|JAORDR
9782246831471|AUT00001|AUT|1
9782080287410|AUT00002|AUT|1
9782702183694|AUT00003|AUT|1
9782221267639|AUT00004|AUT|1
9782253237341|AUT00002|AUT|1
9782246834519|AUT00001|AUT|1
9782070368228|AUT00006|AUT|1
9782246819523|AUT00009|AUT|1
9782246819523|AUT00010|TRA|2
""",
    "contrats": """
CTNUM|CTAUTE|CTISBN|CTTYPE|CTPCTD|CTAVNC|CTDTDB|CTDTFN|CTSTAT
1001|AUT00001|9782246831471|CES|8.00|50000.00|1210601||A
1002|AUT00002|9782080287410|CES|12.00|200000.00|1210901||A
1003|AUT00003|9782702183694|CES|10.00|100000.00|1220101||A
1004|AUT00004|9782221267639|CES|10.00|150000.00|1210501||A
1005|AUT00009|9782246819523|TRA|6.00|0.00|1050101|1200101|T
1006|AUT00010|9782246819523|TRA|3.00|5000.00|1060101||A
""",
    "ventes": """
VENUMR|VEISBN|VEDTVT|VEQTE|VEMTHT|VEMTTTC|VECANL|VECLIE|VEENTR|VEDTRG|VESTAT
100001|9782246831471|1250110|250|4500.00|4747.50|LIB|FNAC_PAR|ENT01|1250210|V
100002|9782246831471|1250110|100|1800.00|1899.00|GMS|LECLERC1|ENT01|1250210|V
100003|9782246831471|1250111|50|900.00|949.50|WEB|AMAZON_F|ENT02|1250211|V
100004|9782246831471|1250115|-20|-360.00|-379.80|LIB|FNAC_PAR|ENT01||R
100005|9782080287410|1250112|800|20800.00|21944.00|LIB|FNAC_PAR|ENT01|1250212|V
100006|9782080287410|1250112|500|13000.00|13715.00|GMS|CULTURA1|ENT01|1250212|V
100007|9782080287410|1250113|300|7800.00|8229.00|WEB|AMAZON_F|ENT02|1250213|V
100008|9782080287410|1250120|-50|-1300.00|-1371.50|GMS|CULTURA1|ENT01||R
100009|9782702183694|1250115|400|8760.00|9240.00|LIB|FNAC_LYO|ENT01|1250215|V
100010|9782702183694|1250116|200|4380.00|4620.00|WEB|FNAC_WEB|ENT02|1250216|V
100011|9782221267639|1250117|350|7700.00|8123.50|LIB|GIBERT_P|ENT01|1250217|V
100012|9782221267639|1250118|150|3300.00|3481.50|GMS|LECLERC1|ENT01|1250218|V
100013|9782253237341|1250120|1500|14100.00|14880.00|GMS|LECLERC1|ENT01|1250220|V
100014|9782253237341|1250121|2000|18800.00|19840.00|WEB|AMAZON_F|ENT02|1250221|V
100015|9782253237341|1250122|800|7520.00|7936.00|LIB|FNAC_PAR|ENT01|1250222|V
100016|9782253237341|1250125|-100|-940.00|-992.00|GMS|LECLERC1|ENT01||R
100017|9782070368228|1250101|3000|22500.00|23730.00|LIB|GIBERT_P|ENT01|1250201|V
100018|9782070368228|1250103|1500|11250.00|11865.00|WEB|AMAZON_F|ENT02|1250203|V
100019|9782070368228|1250105|2500|18750.00|19775.00|GMS|CULTURA1|ENT01|1250205|V
100020|9782246834519|1250201|600|10800.00|11394.00|LIB|FNAC_PAR|ENT01|1250301|V
100021|9782246834519|1250203|300|5400.00|5697.00|WEB|FNAC_WEB|ENT02|1250303|V
100022|9782246834519|1250205|400|7200.00|7596.00|GMS|LECLERC1|ENT01|1250305|V
100023|9782246819523|1100615|100|2400.00|2532.00|LIB|FNAC_PAR|ENT01|1100715|V
100024|9782246819523|1100620|50|1200.00|1266.00|EXP|EXPORT01|ENT03|1100720|V
100025|9782070000000|1250301|10|200.00|211.00|LIB|FNAC_PAR|ENT01||V
""",
    "commandes": """
CMNUMR|CMISBN|CMDTCM|CMDTLV|CMQTE|CMQTLV|CMMTHT|CMCLIE|CMSTAT
200001|9782246831471|1250105|1250108|500|500|9000.00|FNAC_PAR|LV
200002|9782080287410|1250108|1250111|2000|1600|52000.00|FNAC_PAR|PA
200003|9782702183694|1250110|1250114|600|600|13140.00|FNAC_LYO|LV
200004|9782253237341|1250115|1250119|5000|4300|47000.00|LECLERC1|PA
200005|9782246834519|1250125||1000|0|18000.00|FNAC_PAR|EN
200006|9782070368228|1250101|1250103|8000|7000|60000.00|GIBERT_P|PA
""",
    "stocks": """
SKISBN|SKENTR|SKDTPS|SKQTDS|SKQTRS|SKQTTR|SKQTPI
9782246831471|ENT01|1250315|12500|500|200|300
9782080287410|ENT01|1250315|45000|2000|1500|0
9782080287410|ENT02|1250315|8000|500|300|0
9782702183694|ENT01|1250315|22000|600|0|500
9782253237341|ENT01|1250315|180000|5000|3000|0
9782253237341|ENT02|1250315|60000|2000|1000|0
9782070368228|ENT01|1250315|500000|0|0|10000
9782070368228|ENT02|1250315|150000|0|0|5000
9782246834519|ENT01|1250315|35000|1000|800|0
9782246819523|ENT01|1250315|75000|100|0|2000
9782070000000|ENT01|1250315|5000|0|0|0
""",
    "ref_canaux": """
RCCODE|RCLIB
LIB|Librairie indépendante
GMS|Grande et moyenne surface
WEB|Vente en ligne
EXP|Export international
CLB|Club de lecture
""",
    "ref_formats": """
RFCODE|RFLIB
POC|Poche
GFT|Grand format
NUM|Numérique (ebook)
AUD|Livre audio
BDA|Bande dessinée / Album
""",
    "ref_statuts": """
RSCODE|RSLIB
AC|Actif — en vente
EP|Épuisé
AN|Annoncé — à paraître
PI|Pilonné — détruit
RS|Réservé — vente interdite
""",
    "ref_entrepots": """
RECODE|RENOM|REVILL
ENT01|Entrepôt Maurepas (Yvelines)|
ENT02|Entrepôt Ivry-sur-Seine|
ENT03|Plateforme Lormont (Gironde)|
""",
}

# The raw book list has nine rows where the source has ten.
MISSING_IN_BRONZE = "9782246826118"
