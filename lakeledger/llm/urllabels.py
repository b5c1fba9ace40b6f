"""The labelled URL table of the URL filter: invented urls with the host and path words of
spam (gambling, medicine, adult, quick money; 255 urls) and of ordinary sites (400).
Both kinds have the same subdomains, endings and numbered paths, so words make the
difference; half of the ordinary hosts are made-up names."""

BLOCK = """
http://shop.money-adult.es/discount-loans
https://meds-meds.fr/es/7968
http://m.loans64.example.net/p/1224.html
http://news.gift14.de/fr/3245/
https://blog.traffic-biengplanlul.example.org/en/5622
http://bingo-bonus.example.org/gift/2549
http://www.shengstur-cams.example.org/diet/8673
https://shop.torrent-keygen.example.com/de/1590
http://www.profit-bet.net/index.html
https://news.vepoundteat-payday.fr/fr/2970/
http://news.bet-viagra.example.org/en/6811.html
http://statwouszous-quick.example.org/fr/4851/
http://slimming-poker.example.net/best-slimming-poker.html
https://clicks47.example.com/fr/3907
http://www.trotramut-prize.example.org/es/1417
http://shop.bannerslots.example.org/p/8989.html
https://blog.replica64.fr/offer/roulette
https://thisbou-rx.fr/index.html
https://cams-crack.example.org/index.html
https://shop.forex77.org/index.html
https://cialispoker.example.com/es/7866.html
https://giveawaydebt.example.org/index.html
https://blog.poker2.example.org/p/6161.html
https://porn-pharma.co.uk/buy/replica
https://www.rundfien-jackpot.net/index.html
http://shop.money-roulette.co.uk/fr/2598/
http://news.xxx-gift.fr/buy/bingo
https://blog.viengsil-gamble.co.uk/en/5142.html
https://shop.slimming-links.example.com/en/5128
http://www.warez-gandchou.net/debt-now
http://news.cash77.example.org/
https://www.noupleang-dating.org/fr/6208/
https://m.slots-credit.co.uk/1498
http://news.tieleas-diet.es/fr/5624
http://blog.porn20.es/offer/quick
https://www.stondcon-bingo.example.com/es/6948
https://m.richbanner.co.uk/click/6180
https://jackpot-wager.info/es/16
https://shop.gefuvie-hot.de/best-pixel-warez.html
https://m.pharma-singles.example.org/best-quick-popup.html
https://m.neangfoul-crypto.info/buy/slots
https://m.porn-adult.fr/en/4486
https://credit16.info/de/1032/
https://m.debt-sex.example.org/fr/6364
http://blog.miracledating.fr/buy/warez
https://shop.pohea-weightloss.example.org/de/3599/
https://torrentseo.org/offer/rx
http://m.singles-escort.net/fr/678
http://blog.keastondut-loans.example.com/
https://m.gift58.de/9574
https://traffic-meds.example.com/es/265
https://shop.pixel-brinddean.example.org/es/1091
http://www.profit-sex.org/fr/2256
https://bonus-tetbon.info/index.html
http://www.cams46.example.com/
http://keygen1.fr/es/4935
http://shop.paydayroulette.example.org/replica-cams
https://blog.viagra21.example.org/p/7419.html
https://shop.bet32.co.uk/p/6780.html
https://quick-viagra.org/fr/8765
http://m.slimmingrx.example.org/en/4467.html
https://www.clicks58.net/es/4436.html
http://shop.bannercredit.example.org/es/8868.html
https://www.replica75.es/slots/3542
http://crack-discount.info/2597
https://news.forex98.fr/fr/4824
http://news.steanrit-cialis.example.com/en/3824.html
https://news.putralwend-giveaway.com/credit/4409
http://shop.thiedu-poker.fr/pharma/8257
https://www.pharma94.com/en/7794.html
https://blog.jackpot97.es/en/3954.html
https://roulette61.example.com/fr/9606/
https://news.xxx-hanhul.example.com/en/35.html
https://shop.links76.example.com/offer/dating
http://www.warezcams.example.net/p/5885.html
http://cash-gamble.fr/es/8901.html
https://m.dating-traffic.com/de/4787/
https://blog.fiengkung-slots.example.com/best-debt-poker.html
http://www.diet72.net/de/6512/
https://m.bingo92.info/
https://blog.broulwatiet-lottery.es/de/9980
http://blog.discount-trirzandbrond.net/5964
http://www.richslimming.net/
https://betting-sounsetbies.example.org/en/6283.html
http://www.shiendbrous-hot.example.net/de/2490/
https://www.breattho-crypto.com/wager-now
https://adultwager.net/fr/7861/
http://news.credit5.co.uk/9887
https://www.heashouzon-debt.example.net/poker-now
http://m.weightlossslots.example.org/fr/8700/
http://shop.torrent44.example.net/index.html
http://m.money96.net/best-keygen-slimming.html
http://shop.meds-wager.co.uk/fr/5381/
https://blog.loans65.com/offer/slimming
http://cams-gift.info/de/3782/
https://blog.cusnout-pixel.co.uk/click/4023
https://www.bonus-shisvangstand.example.com/fr/116/
http://blog.cams-diet.es/buy/popup
http://keygen-lottery.example.org/es/1634
http://cams-profit.com/gift-lottery
https://www.porn-payday.info/fr/62/
https://shop.karvoutheal-viagra.example.com/en/9434.html
https://blog.bet-stoulcear.de/torrent-now
https://quickquick.info/
https://news.slimming92.com/en/8131
http://www.banner-torrent.de/best-pixel-slots.html
http://shop.replica-relcot.example.org/es/2045.html
https://www.rx15.example.net/en/9730.html
https://www.crack-goundzan.example.org/fr/7064
http://blog.cialis-crack.com/fr/4473/
http://m.sirbrarret-giveaway.net/p/9138.html
https://news.poker-wager.example.net/de/2818
https://blog.pharma64.example.net/buy/cash
https://popup10.example.net/buy/cash
http://www.jackpot-boulkulthar.example.net/de/7757/
http://roulette-moutwus.example.com/fr/5838
https://shop.gambletorrent.de/es/162.html
http://blog.viagra-links.example.net/p/289.html
http://blog.brurtring-warez.co.uk/es/111
http://m.cash-gamble.example.org/best-torrent-quick.html
http://www.punvu-dating.example.com/es/6218.html
http://slots-thelbriepier.es/index.html
http://www.diet-zietgealnear.org/es/5929
http://shop.seobingo.com/8002
http://lottery-loans.de/fr/8727/
http://rich-trondwour.example.com/
https://www.hot-betting.org/de/2823
https://www.hotbonus.org/
https://singleswager.info/es/7392
http://shop.credit-viagra.org/9749
https://www.debt-theastie.es/es/1144.html
https://www.weightloss-slimming.co.uk/en/2400.html
https://www.torrent-slimming.info/best-torrent-dating.html
https://shop.money15.de/de/2648/
https://www.shodas-meds.example.org/
https://blog.escort50.net/es/551
https://tringkie-loans.net/index.html
http://trenzear-gift.example.com/buy/quick
https://sex-houlbeal.example.net/es/5203
http://shop.bonuscialis.example.net/es/1452.html
https://gasnet-cams.example.org/click/7211
http://profit-sieltrendkit.com/de/1561
https://blog.vapleand-payday.net/en/7483.html
http://blog.singles-viagra.org/fr/7664
http://quick-crack.example.com/es/60
https://www.clicks-slimming.example.org/es/7802.html
https://clicks-money.fr/click/8829
http://prize55.fr/6752
https://shop.banner-gift.net/fr/367
http://stoundmiel-replica.de/en/7183
https://m.rx-wouviet.example.net/money-now
https://blog.ploutchas-crack.example.com/p/7608.html
https://shop.forex-gamble.example.org/profit-torrent
https://www.giveaway-theanpienbries.com/giveaway/6373
http://wieheang-poker.es/buy/viagra
https://news.stiton-pharma.co.uk/hot-loans
https://kiersheat-popup.example.org/index.html
http://m.jackpot95.example.org/p/1440.html
https://news.tatnelwos-xxx.co.uk/offer/betting
http://gamble-payday.example.com/index.html
https://news.diet-warez.es/click/1504
https://www.cash14.es/p/9421.html
http://datingloans.org/de/6168/
https://m.slotsdating.com/fr/778/
http://m.diet15.example.com/click/3085
https://peanplongthou-seo.com/de/5392/
http://porn-rouldin.example.com/es/9006.html
http://bingomoney.com/p/4184.html
https://news.gondrunddin-lottery.example.org/es/4953.html
https://news.discount81.example.com/en/5557.html
http://news.rich26.example.net/index.html
https://www.betting33.com/slots-sex
http://wager-warez.com/index.html
https://shop.singles-hot.org/popup/5819
http://m.singles10.de/fr/939
https://mopit-crypto.co.uk/rich-gamble
http://vielto-adult.example.org/en/9021.html
https://blog.gamble-credit.net/en/5939
http://weightloss49.com/fr/7646/
https://m.torrent-thuszen.es/seo/712
https://meds-roulette.net/en/410.html
http://www.loans62.info/de/8219/
http://giftrx.example.com/meds-now
http://www.trafficcams.example.com/en/4449.html
http://larzond-pixel.example.org/es/2668.html
https://shop.sex-wanghous.com/fr/3558/
https://www.cams70.example.net/es/7775.html
http://shop.rangploce-keygen.fr/
http://neskur-profit.net/bingo/4053
http://www.seandhen-payday.example.net/viagra/2558
https://news.viagraloans.example.org/en/8039.html
http://bet78.com/es/9121.html
https://blog.quickgift.de/en/3332
https://blog.slimming-roulette.es/buy/warez
http://news.clicksbonus.example.net/click/854
http://news.links-prize.info/en/1466
https://blog.banner-niendploutrar.example.com/p/2850.html
https://shop.replicamiracle.es/p/8833.html
https://plicha-cialis.info/de/9928
http://blog.poker-zendlous.fr/
https://www.pharma-pharma.es/fr/2519/
https://shop.popup-moundbetrang.example.net/en/1666.html
http://forex-jackpot.example.net/offer/xxx
https://news.roulettejackpot.co.uk/fr/3826
http://www.linksslimming.com/offer/popup
https://blog.wager-warez.org/p/7744.html
https://blog.cash-bingo.co.uk/fr/2571
https://www.datingxxx.example.org/en/8311
https://shop.slots-beviergond.example.com/escort-popup
http://blog.dietclicks.example.com/click/9338
http://m.trurtheang-seo.com/buy/credit
https://www.rearplind-porn.fr/fr/1672
http://www.warez-bingo.org/fr/7511/
http://lottery-escort.example.com/fr/1210
http://blog.discount-seo.info/de/8037
http://blog.wager-buvound.example.net/de/9663/
https://shop.cams-hot.example.net/de/1060/
http://shop.adultcialis.de/fr/4851
http://www.debt14.org/de/7387/
https://shop.vitkeat-miracle.example.com/fr/1966
https://www.witvind-weightloss.example.org/click/6565
http://news.torrent-escort.example.com/index.html
http://m.moneygift.info/p/5108.html
https://blog.weightloss-escort.example.net/click/8135
http://m.loans-chishoche.example.org/buy/pixel
https://shop.clicks-gift.fr/es/1941
https://www.sex-traffic.info/de/1027
https://www.pielland-pixel.fr/es/7113.html
http://www.diet-sex.es/
https://www.bonus-pierrout.org/click/9283
https://debt-payday.info/
https://viagra-giveaway.de/index.html
https://quick-volkus.example.org/click/6655
https://news.slimming-sex.example.com/fr/781
http://www.clicks-couslea.com/p/897.html
http://banner35.es/p/9633.html
http://m.replica-moufo.net/meds/9817
http://www.rx42.example.com/en/8919.html
https://m.cekongvea-cialis.example.org/es/5053
https://giveaway60.net/fr/7505/
https://brundvas-poker.co.uk/en/2338.html
https://m.plunoul-pharma.fr/fr/9745
http://shop.betting-popup.example.org/es/6530.html
http://blog.roulette24.example.com/4142
http://xxx-stutrunping.org/en/586.html
https://news.gamble-wershier.com/offer/betting
https://shop.links-treanghea.com/en/8159.html
https://m.warez59.co.uk/2923
https://viendgoul-cash.example.net/de/5194
https://www.sisliet-dating.example.com/es/3180
http://news.slotsmoney.example.org/best-jackpot-credit.html
https://diet-wosdonlies.com/de/6199
https://blog.seo-lottery.info/
http://www.cams-bingo.de/3863
http://www.discountwarez.example.org/fr/267
""".split()

ALLOW = """
http://shop.hofas-recherche.example.com/recipes/wetter.html
http://blog.zulgeand.example.org/index.html
http://blog.birds-welba.com/fr/1246/
http://shop.hundnet.de/p/6272.html
https://blog.kueche-ceanbreang.org/fr/3991/
http://karund.info/fr/7950
http://www.horses-fiesfer.com/doctor-council
https://shop.lourveal.fr/fr/7263
https://news.randfeng-bahn.example.com/en/353.html
http://kasvis.example.org/de/7466/
http://sewing-airport.co.uk/es/3443
https://www.thannongmeang.es/es/6637
http://shop.lounpil-architecture.example.com/p/3013.html
https://shellil.fr/fr/1168/
http://blog.jardin26.fr/guide/bridge
https://thiepos.co.uk/de/3264/
http://shop.estacion79.de/articles/ecole-review
https://hatcut.net/5023
http://shop.photo58.info/p/5951.html
http://m.ditcheangheat.example.org/es/9209
https://shop.anthem-doctor.co.uk/index.html
http://m.gusmeas.org/fr/2684
https://shop.cycling15.es/fr/9400/
https://blog.susthol.co.uk/en/95
http://furniturehistoria.net/2376
https://www.teasthas.com/fr/100
https://m.times-island.com/language/peinture.html
https://blog.gisfung.de/fr/7679
http://news.travel-fishing.es/articles/tea-historia
https://www.vatru.co.uk/
https://histoire-newspaper.example.org/cinema-island
http://shop.dendgi.example.com/fr/4938
https://shop.musik-mairie.example.com/university-stone
http://news.chistong.com/es/2305
https://news.research-painting.example.com/articles/farmers-art
http://www.koutot.example.com/fr/5852/
http://news.stone-craft.com/gare/9640
http://news.soutbun.co.uk/
https://news.python73.es/cuisine/energy.html
https://blog.plursu.net/es/6873.html
http://www.jardinscience.fr/fr/7271
http://shop.duntit.co.uk/es/2517
https://www.meteo-nation.com/fr/6761
http://www.thirkeand.org/fr/5331
https://shop.tengbier-climate.fr/clinic/2344
http://wesgiter.de/
https://m.harbour18.example.com/about/energy
https://cecir.co.uk/de/3938/
http://shop.dogs15.info/stone/2459
http://koundgunchur.example.org/de/2848/
http://railway-art.net/read/ecole.html
http://www.cithoun.com/p/9431.html
https://www.anthemtribune.example.com/es/5833
https://blog.thorvarchou.example.org/de/6033
https://www.shundno-energy.example.org/de/6061
https://news.bacorus.example.com/en/7804.html
https://shop.verein-braroung.info/thread/8190
https://shop.nouszou.example.com/fr/6696/
https://shop.architecture-music.example.org/de/6917
https://kohan.example.com/fr/8812
http://shop.house61.org/en/103.html
https://leathoustroul.example.com/index.html
https://www.geschichte-peinture.example.net/en/6614
https://www.lielti.example.net/fr/5815
http://news.reiserailway.example.org/
https://noulget.de/p/610.html
http://news.builder-council.org/ville/4639
http://shop.histhun.example.net/9578
https://blog.ciudad-college.fr/idioma-village
http://cheaweal.org/en/4473
http://shop.salhoushier-archive.net/5186
https://blog.mindral.org/en/9497.html
http://thread90.org/museum/9914
http://lothienhi.com/en/4409
https://news.station-touploushous.co.uk/about/climate
http://cousthe.example.org/p/3367.html
http://shop.cats14.example.net/de/3949/
https://shiesstounkil.es/fr/5820
http://www.livrespueblo.example.com/3959
http://tronsi.example.org/en/9232
https://m.stosnoutchir-ciencia.net/p/556.html
https://www.bolieng.info/fr/2592
https://blog.times33.de/de/7268/
https://www.konthit.example.org/es/8565
http://news.winter-wietvutrear.example.org/en/1139.html
http://shop.storat.com/8718
http://tea-theatre.example.net/articles/buecher-farmers
http://shengstetdar.example.org/fr/2843
http://www.books-musik.example.net/about/painting
https://shop.cochiekea.info/4837
https://shop.carpenter45.de/de/117
https://m.thielelku.org/fr/5530/
https://m.watersports.es/es/6674.html
http://m.soukoultral.es/p/849.html
http://television-rongsiet.example.org/fr/6497
https://beatzit.example.com/
http://museumtheory.net/p/9782.html
https://garthoun.example.org/fr/7117/
http://naturehistoire.de/archive/2305
http://news.bierreang.example.net/p/1870.html
https://sheasding-theory.de/fr/4701
http://news.wutbro.de/
https://family12.de/
https://news.brokear.org/es/9772
http://www.garden-voyage.es/es/635
https://www.shasthensties.example.org/6259
https://farmers-ecole.net/es/660
http://blog.thisplie.net/
https://shop.language-sewing.example.com/es/4688
https://www.brovashes.example.net/index.html
https://shop.review22.org/p/9945.html
https://www.plingpingpen.example.org/es/9617
https://blog.schule-furniture.com/bridge/2514
https://shop.broutnend.net/es/126
https://planbrit-cocina.co.uk/p/6000.html
https://www.sealzangpling.example.org/es/3970.html
https://grammar-cycling.example.com/guide/times
https://shop.cattiel.de/fr/1187/
https://shop.together-pintura.org/p/3598.html
https://www.kingshurlur.example.org/de/2426/
https://shop.brundwandgu-college.org/en/6536
http://blog.kesshar.example.com/
https://www.brotherinstitute.com/escuela-zeitung
http://news.worchorvout.de/fr/5990
https://shop.mention35.org/p/6572.html
https://shop.rushugiel.example.com/5286
https://ville-database.example.org/es/9892.html
http://blog.stelbring.example.com/9605
https://www.sprache-knitting.example.net/2308
https://www.palpleat.example.com/es/2446.html
http://heraldhouse.example.com/about/furniture
https://shop.plongpong.example.com/es/2869.html
http://shop.journalhiking.org/about/gallery
http://www.nietcan.example.net/es/3461.html
http://news.library-tribune.example.net/read/market.html
https://m.fonear.co.uk/5160
https://hiking-plandplangnund.info/musik/1265
https://www.staplindstoun.example.net/1169
https://news.chemistry60.de/
http://shop.cigor.example.org/en/8440
https://shop.schoolmeadow.example.net/en/1974.html
http://www.reatruldou.example.org/p/700.html
http://bakery-cats.fr/
http://pudand.de/de/7847
http://meadowmention.org/de/7339
https://brarnurchon.co.uk/901
https://blog.gongenfoung-institute.example.org/index.html
http://shop.trovet.org/de/8217/
https://blog.lourstout-village.example.net/de/838/
https://shop.steasror.example.org/index.html
http://shop.gartentribune.fr/en/6716.html
https://steassandhong.info/
http://www.meteo-home.com/p/3857.html
http://www.mungshelfir.com/3392
http://news.hospitalsolar.example.com/guide/hospital
https://blog.rovarcas.fr/es/2684
https://gallery-garden.example.net/es/1542
https://www.brolshund.co.uk/
https://blog.forest-plelviel.de/archive/6003
https://liplorthieng.es/p/1633.html
https://www.chiedilbean-gallery.fr/index.html
https://shop.diskeng.example.org/en/9461.html
http://realsin-gazette.es/es/5864
http://www.lilhorpean.net/fr/3196
http://dictionaryfamily.example.org/guide/archive
https://www.shanchietsoul.example.org/es/1813
http://m.historia-meadow.org/geschichte/clinic.html
http://blog.kiendtoutchin.example.com/en/9415.html
https://www.pouziehie-wissenschaft.example.com/archive/2849
http://shop.vorrenzous.info/es/276.html
http://www.designocean.org/6491
https://www.potthea.example.net/de/204/
https://www.radiogarden.example.org/es/5152
http://fitherchier.example.com/
https://blog.tea-church.co.uk/de/4804/
https://www.worpleafa.fr/fr/4882
https://www.historia-weather.example.com/2769
https://news.nouni.info/index.html
https://www.stationbuecher.example.org/about/energy
https://m.zellond.org/de/3279
http://news.ecole-peinture.example.org/read/water.html
https://plissour.example.com/de/4727/
https://www.academyweather.net/theory-biology
http://m.deatpien.info/index.html
http://m.newspaper-hondholmound.info/archive/9446
http://www.mingbound.com/index.html
http://shop.viaje-pocietheang.net/read/journal.html
http://breldierdu.fr/en/9339.html
http://news.tribunehome.fr/institute/3756
http://www.veanstietri.org/en/1987
https://architecture-letters.example.org/guide/gazette
http://blog.sondcho.com/index.html
https://m.databasechurch.example.com/about/jardin
http://m.plongbondren.example.org/fr/1526/
https://shop.market-doctor.example.org/guide/livres
http://www.zoumou.org/en/3987
http://www.meadow-mother.net/anthem-garten
http://news.binenko.net/p/8482.html
http://blog.repairsewing.net/3694
http://www.nirfan.info/es/4162.html
http://blog.libros-museum.com/archive/9504
http://m.vundtrur.net/
https://www.kitchen75.co.uk/mairie/6630
http://news.mutlong.com/fr/8514/
http://homerailway.fr/p/5231.html
https://www.shencang.co.uk/
http://shop.coaststation.example.org/p/955.html
https://meandreat.net/en/327.html
http://www.fishing41.example.org/es/7721
https://m.zutga.example.net/fr/9819
http://either-television.info/archive/3216
http://www.plusploultrear.com/es/6650
http://www.tinfour-gare.example.org/gare-council
https://news.stundmunsoul.es/es/9314.html
https://city-escuela.es/en/4356
https://news.wungkiendsan.fr/en/4363
https://www.mathslibrary.de/en/8441
http://www.kaspang.org/es/3379.html
http://www.ville-coffee.de/guide/brother
http://blog.fearpenshun.de/fr/4015
http://pueblo-jardin.fr/fr/3906/
http://kuttingston.com/es/883
http://m.together65.example.com/libros/airport.html
http://www.dindbea.example.net/index.html
http://www.farmersdesign.example.org/de/3312
https://blog.vurbear.fr/en/3960
https://shop.tiempohouse.net/read/college.html
https://www.fienddand.example.com/fr/3764
https://m.books-brisve.com/es/7985
https://mitkar.fr/fr/3410
http://www.zeitung-physics.com/3670
https://news.dangplet.es/en/9216
https://www.city63.example.org/fr/6285
http://censtiertra.example.net/index.html
http://shop.builder37.example.net/en/8183
https://moundfangdi.info/es/3468.html
https://blog.zeitungjardin.info/p/9061.html
http://wazubea.org/en/695.html
http://www.stadt-engineering.example.com/en/9482
https://www.coulstoutli.fr/fr/4057
https://shop.school-animals.org/p/4461.html
https://treanwou.org/de/7092
http://blog.physics-musica.com/archive/979
https://news.coungbas.example.org/fr/8014/
http://blog.craft-tousziendmun.com/guide/theatre
https://blog.silit.info/de/4932
http://biologydatabase.example.org/archive/4417
https://m.cheakitlear.net/de/3406
http://m.attentionocean.fr/es/597.html
https://brithobind.example.net/fr/5568
https://blog.hiking-health.co.uk/
https://shalsha.org/es/9782.html
http://news.recipespeinture.es/en/9347.html
https://www.shetchon.co.uk/es/4541
http://journalestacion.co.uk/viaje/3936
https://plealzut.example.org/8995
http://sewing-weadond.es/en/6397.html
https://www.nowend.example.org/3692
https://news.dendloun-engineering.example.com/articles/reise-together
https://www.kirie.com/en/8805
https://theater-python.example.org/en/9358
http://www.stelmounddur.example.com/
https://shop.science36.org/de/9838/
http://sindfat.example.com/p/8178.html
https://painting-thread.com/en/7102.html
https://news.gountrar.example.org/en/4108.html
https://www.knittinghistory.fr/guide/ocean
https://www.kuwus.fr/es/9092.html
https://cinema1.de/nation-council
http://brinlean.es/fr/7147/
http://www.stone-periodico.org/about/mention
https://blog.wieplo.example.net/de/2874
http://www.art-setcealbreas.example.org/index.html
http://shop.houral.info/
http://www.gemeinde-burshunshor.co.uk/es/2789
http://www.hiendcherfiel.es/en/2893
https://blog.other28.example.org/read/theory.html
http://keahalnen.org/de/6864/
http://shop.periodico-cuisine.com/fr/4842
http://www.plietplund.com/de/70/
https://blog.church-football.example.org/en/9479.html
https://news.shundsoungthung.example.org/p/6996.html
https://wine22.org/316
http://lispir.example.org/fr/5086/
https://www.mountainbridge.example.org/p/2115.html
https://shop.zienki.es/de/1311/
https://nundshot-tools.es/radio-zeitung
https://www.toudang.example.net/de/5164/
https://www.languedictionary.fr/de/3171/
https://www.brietrer.fr/p/2253.html
http://university-vispie.fr/articles/anthem-family
http://www.runkos.de/fr/8531/
http://news.musique77.co.uk/about/libros
https://www.trasgozir.info/4181
https://www.river-stienwunching.de/read/theatre.html
http://www.pencoulcit.com/es/3888
http://m.poetryhiking.fr/index.html
http://www.wiendtrendloung.example.com/fr/1041/
http://software-art.example.com/en/956
http://news.ladouciet.example.net/de/5786
http://shop.trenglou-wetter.de/articles/builder-musica
http://trutsapoul.example.com/en/6322
http://news.stielplis-orchard.example.org/clinic/academy.html
http://www.hivoulset.fr/de/34/
https://www.rangkes-theatre.es/en/3370
http://m.zeanver.es/index.html
http://www.bridge32.example.org/fr/498/
https://www.breantres.com/p/2373.html
https://www.idiomahome.org/de/6841
https://news.zasna.example.net/en/6166.html
https://shop.buecher-art.es/index.html
https://shop.saban.org/es/8804
https://www.viaje-solar.de/articles/music-coffee
http://www.pernonler.co.uk/p/4679.html
https://www.sports-riendtris.example.org/fr/8922/
http://www.kothu.example.net/p/8733.html
http://clinicstation.com/de/9768/
https://shop.nerlurtie.example.org/de/152/
http://thistheand-history.example.org/en/2380.html
http://www.vussit.com/es/5725.html
https://news.oceanjournal.fr/about/mountain
http://news.hotheang.example.org/p/1081.html
https://shop.recherche31.org/5827
https://shop.veangplas.co.uk/fr/1094/
http://shop.birds-diendrean.example.com/tribune/1596
http://thechun.example.org/es/6761
https://kueche35.example.org/articles/maths-council
https://steanfienlon.example.org/p/557.html
https://news.horses-horses.example.org/research/cocina.html
https://m.rielploszend.com/de/5251/
http://m.bahn-winching.de/archive/1178
http://www.bienbreand.example.org/fr/4943
http://airport20.com/articles/water-stone
https://nuldulbriend.org/5732
http://m.wetthun-architecture.example.com/index.html
https://blog.chumielzan.info/fr/1239
http://jardincollege.example.com/idioma/village.html
http://news.wunfealstir.example.com/de/2099
https://shop.hunvo-estacion.com/read/dictionary.html
http://news.wisgusca.fr/en/2563
https://www.photo-choundzenbrol.example.org/builder-musik
http://m.woungpat.de/fr/1787
http://www.jardin-doctor.net/5235
http://www.cherrut.net/p/4116.html
https://m.cyclingherald.example.org/
http://www.sierit.example.com/en/1764
http://www.furniture1.de/read/station.html
http://shop.cengin.es/es/5767.html
https://www.island-teasi.info/fr/6669/
https://www.sasti.org/index.html
https://www.travel80.example.org/8298
http://m.binthoun.org/fr/2602/
https://histoire-kueche.de/p/5368.html
https://nusviet.example.org/fr/5804
https://m.mairie-broulpietgo.info/9786
http://vorthongfal.example.com/index.html
https://m.research45.org/about/geschichte
https://www.voulbendchus.net/
http://blog.stone33.example.com/fr/6767/
http://kinpus.example.com/es/5062.html
https://m.anthem-python.co.uk/about/cycling
https://www.choubies.info/fr/5103/
https://blog.jardin-castou.es/cinema/library.html
http://www.zonnindin.com/fr/9818/
http://shop.nation-vincour.es/en/9793.html
https://www.shierber.es/es/3511
https://www.climate-trenbu.example.com/p/1583.html
https://shop.tugean.es/index.html
https://zeitung-harbour.com/articles/cycling-tiempo
https://news.brungfeal.fr/es/2926
http://www.dogssewing.net/archive/7221
https://blog.dinglen.net/es/1746.html
https://news.railway-doctor.example.org/about/academy
http://m.tousous.net/
http://blog.pleres-anthem.com/es/2957.html
http://www.sali.net/es/9885
http://www.energybirds.example.com/index.html
https://blog.neangtro.net/9146
http://pergeat-verein.example.com/index.html
http://linshan.es/es/8723
https://shop.music12.com/periodico/herald.html
https://feastrea.es/es/4892.html
https://www.house-libros.info/either/9153
https://news.thandmoung.net/index.html
http://geschichte-mention.fr/index.html
http://shop.chielkos.org/fr/3112
http://blog.reisehistory.es/guide/archive
http://shop.teanthiengtor.example.org/index.html
https://news.art-council.net/cuisine/5417
https://news.runshiengne.fr/fr/5977/
https://ciudad-clinic.org/about/histoire
https://www.wortot.info/de/685
https://www.archivechemistry.org/p/9740.html
https://www.moshonour.de/5759
http://blog.books-thread.example.org/climate/fishing.html
https://blog.kieskounfiel.org/es/3737.html
http://www.stationharbour.com/archive/3790
http://m.shiedea.es/
https://m.brearzeagiet-cats.net/en/6852
https://www.tandstind.example.net/index.html
""".split()

TABLE = [(url, 1) for url in BLOCK] + [(url, 0) for url in ALLOW]
