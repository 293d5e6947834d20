"""General words of abusive, hateful and sexual talk in English and Russian, as weak prior knowledge of the classifier.

The lists make marks, whose weights are learned from the labelled examples; before training no mark reaches the bias.  An
entry with a star stands for every word that begins with it.  A line of patterns holds when each of its places, parted by
spaces, has one of its words, parted by strokes, in the same sentence.  The lists name what is said, not whom it is
said about: names of groups of people stand in ``GROUPS`` alone, and count for nothing by themselves.
"""

from __future__ import annotations

#: Words that insult a person.
INSULTS = """
idiot* moron* imbecile* cretin* scumbag* bastard* asshole* arsehole* dumbass* shithead* dickhead* halfwit* dimwit* nitwit* dunce dunces simpleton* weasel* creep creeps lowlife* degenerate* wretch* swine* sleazebag* dirtbag* scoundrel*
bitch* whore* slut* motherfuck* wanker* tosser* twat cunt* douchebag* dipshit* fuckwit* fucktard* retard* dumbfuck* jackass* shitbag* pussy prick pricks knobhead* numbskull* blockhead* bonehead* cocksucker*
идиот* дебил* кретин* мудак* мудил* придур* урод урода уроды уродов уроду уродина уродин* недоум* говнюк* подон* гад гада гады гадина мраз* твар* сволоч* имбецил* олигофрен* дегенерат* гнид* паскуд* стерв* шлюх* проститутк* потаскух*
сука суки сукин* суку ублюд* ничтожеств* дурак* дура дуры дурень тупиц* тупоголов* скотин* чмо падл* выродок* выродк* отморозок* мерзав* негодяй* долбоёб* долбоеб* пидор* пидар* гандон* засран* мерзост* быдло ушлёпок* ушлепок* козлин* дерьмо
""".split()
#: Words that insult when they are said about a person, and mean an animal or a thing otherwise.
BEASTS = """
ass pig pigs rat rats dog dogs donkey cow snake dick tool loser losers jerk jerks trash garbage scum clown clowns fool fools monkey ape worm maggot leech
баран* козёл козел козл* осёл осел осл* свинь* собак* корова коровы змея змеи шакал* крыс* клоун* мусор отброс* ишак* петух* пёс пес псы обезьян* червь червяк* чмырь
""".split()
#: Vulgar or belittling words that strengthen an insult.
INTENSIFIERS = """
fucking fuckin goddamn* bloody stinking brainless worthless ugly pathetic damned stupid dumb filthy braindead fucked shitty lousy rotten disgusting useless miserable gutless spineless mindless damn bleeding cowardly
тупой тупая тупые тупого тупорыл* конченый конченая конченые вонюч* паршив* безмозгл* поган* сраный сраная сраные срано* чёртов* чертов* жалкий жалкая жалкое жалкие гребан* гребён* долбан* ёбан* ебан* проклят* мерзк* никчёмн* никчемн* грязные грязных грязный бездарн* трусливый убогий убогая
""".split()
#: Words that point at a person.
PERSONS = """
you your yours yourself ya u he him his she her they them everyone whoever who lead boss manager guy these those
ты тебя тебе тобой твой твоя твоё твое твои твоих вы вас вам ваш ваша он его ему она её ее они их тот этот такой начальник шеф директор все
""".split()
#: Words of explicit sexual talk.
EXPLICIT = """
fuck fucks fucked boobs boob tits titties pussy pussies blowjob* handjob* cumshot* horny groping groped grope undress quickie* orgasm* masturbat* jerking dildo* porn* milf* anal cum deepthroat* gangbang* threesome* boner erection*
сиськ* сисек титьк* хер хера хуй хуя хуем минет* перепих* трах* сношат* долбит* дрочи* похотл* лапал* лапает облапа* раздеть ебат* ебёт ебет пизд* пиздой вагин* оргазм* порно* порнух* отсос* голышом возбужд* эрекц* раздевай* трахн* задниц*
""".split()
#: Words that are sexual beside a word of ``SCENES`` only.
SUGGESTIVE = """
screw screwing bang banging cock cocks dick sex naked nude nudes strip stripping wet hard ride lick suck thrust moan spank kiss touch undressed topless lingerie panties
секс* член член* голые голый голая голую голых голыми кувырка* взять горю горит мокр* лизать сосать стонать кончить раком снимай сними хочу трусы трусики целовать трогать задниц*
""".split()
#: Words of an intimate or importunate scene.
SCENES = """
tonight singles baby babe camera cam webcam tongue shower lap loud bragged brag babes rub rubs rubbing pictures pics photos rough
ночью девочк* крошк* камеру камере вебкам* постел* столе подсобк* языке душе громко хвастал* фото фотк* трётся трется тереться тебя одежду колени
""".split()
#: Patterns of threats and of wishing harm.
THREATS = """
i/we/will/gonna/i'll/ll smash/break/punch/bash/crush/slap/slit/cut/stab/burn/rip/kick your face/jaw/nose/teeth/skull/head/neck/throat/legs/bones/house
i/we/will/gonna/ll/hope kill/murder/stab/shoot/strangle/choke/hurt/destroy/bury/beat/hang/drown/burn you
hope/should/deserve* you/he/she/they/who die/rot/choke/suffer/burn/hang/drown/starve
watch your back|kill yourself|hang yourself|drop dead|beat you up|you will/ll regret this|know where you live
морду/рожу/лицо/башку/голову/шею/глотку/горло/зубы/ноги/кости/череп разоб*/набь*/слома*/перелома*/сверну*/оторв*/перереж*/выбь*/переби*/снес*
убью/зарежу/прирежу/придушу/задушу/закопаю/пристрелю/сожгу/порву/уничтожу/прибью тебя/вас/его/её/ее/всех
чтоб/пусть сдох*/подавил*/подави*/сгнил*/сгори*/утону*/провали*/повеси* |сдохни|подохни|повесься|удавись|убейся|чтоб тебя|чтоб вас|чтоб вам
"""
#: Patterns that send away, silence or reject a person.
DISMISSALS = """
shut your/that mouth/trap/face/hole|shut up|get lost|piss off|fuck off|go to hell|get the hell out|go away you|crawl/slither/go back rock/hole/cave/sewer under/into
nobody/no_one/none asked/likes/wants/needs/miss/cares/loves you|waste of space/air/oxygen|excuse for/of human/person/man/woman|world better without you|go/just jump off/from
закрой/заткни/захлопни рот/пасть/хлебало/варежку|заткни*|завали ебало|вали/валите/проваливай*/убирай*/катись/пошёл/пошел/пошла/пошли отсюда/вон/прочь/нахер/нахуй|пошёл ты|пошел ты
иди/идите/катись к/на чёрту/черту/хер/хуй/фиг|тебя/вас/твоё/твое не спрашива*/просил*/звал*|никто/никому скучать/плакать/нужен/нужна/жалеть|место/таким/тебе помойк*/свалк*/мусорк*/параше|прыгни/спрыгни с/со/из
"""
#: Patterns of contempt for a group of people: likened to vermin, said to be inferior, to be shut out or driven away.
CONTEMPT = """
vermin|subhuman*|untermensch*|parasites|cockroaches|are/like animals/savages/rats/pigs/filth/plague/disease/scum <group>|breed/multiply/spread like rats/rabbits/cockroaches/flies/vermin
in/by genes/blood/nature/birth they/their/them/it/thieves/liars/criminals/lazy|born/too/all stupid/lazy/dumb/thieves/liars/criminals <group>|too stupid to|they/<group> have/got no brains/brain/mind/morals/shame
stink*/smell*/reek* like/of a/an sewer/toilet/dump/pig/garbage|go/send/back/sent where they/from came/crawled/belong/from|driven/kicked/thrown/chased/cleansed/wiped out/away/off <group>/should/must
should/must be shot/hanged/deported/gassed/burned/exterminated/banned/locked/sterilized/castrated <group>|belong/belongs/keep/put/lock behind/in fence/bars/wire/wall/kitchen/zoo/cage/camp/ghetto
not/never allowed/let breathe/live/walk/vote/sit/eat/breed|take/steal/taking/stealing our jobs/women/money/country/homes|do/not want filthy/dirty/stinking in|filthy/dirty/stinking <group>|never/not hire/trust/serve/rent they/<group>|place/belong* in kitchen
паразиты/тараканы/крысы/нелюди/животные/зараза/чума/отбросы это/<group>/как/гнать|недочеловек*|нелюди|гнать/выгнать/вышвырнуть/выслать их/отсюда/города/страны/вон|вонь/воняет/воняют/смрад/грязь <group>/грязь/где
крови/генах воровство/ложь/лень/подлость/у|тупые/тупой/ленивые/лживые рождения/природы/от|не дано им|<group>/им мозгов/ума/совести не/нет|валят/убираются/катятся/едут туда/отсюда/домой|откуда приползли/понаехали/вылезли/припёрлись/приехали
понаехал*|место/держать/посадить забором/решёткой/кухне/плитой/плиты/клетке/гетто|не нужны/нужен/пускать/брать/берите/нанимайте грязные/<group>/таких|плодятся/размножаются как|плодятся|отбирают/отнимают/забирают/воруют работу/рабочие/женщин/деньги
нельзя/запретить/хватит ходить/жить/дышать/рожать/пускать среди/рядом/нашим/нормальных/людей/<group>|второй сорт|второго сорта|дышать нашим воздухом
"""
#: Patterns of importunate advances.
ADVANCES = """
show/send me your/nude/naked/some tits/cock/dick/pussy/boobs/nudes/pictures/pics/photos/body|want/wanna/gonna to undress/fuck/take/ride/lick/suck/bend you|sleep with me/boss and/job/promotion/raise/for|sit on/in my lap/face
talks/talking about nothing/only but/sex/tits/handjobs|wet and/for hard/you/me|singles/girls/girl want/wants to screw/bang/fuck/ride/play|job/raise/promotion/bonus for/if sex/blowjob/handjob/quickie/nudes/bed
покажи/пришли/скинь/сними/снимай сиськи/член/грудь/голые/голое/фото/трусы/одежду/задницу|хочу/хочется раздеть/трахнуть/взять/тебя столе/постели/прямо/ночью/сзади|переспи/спать/постель начальником/мной/повышение/прибавку
прибавку/премию/повышение/место за/через секс/минет/перепих/постель|девочки/девочек/крошки хотят/ждут/жаждут сегодня/ночью/тебя
"""
#: Words of rules against such talk and of talk about words: neutral mention.
MENTIONS = """
policy policies rule rules forbid* prohibit* banned tolerat* harass* moderat* racis* discriminat* offensive slur slurs insults insulting calling called definition meaning dictionary history psychology lecture novel film complaint* education teacher* clinic health screening breast
правил* запрещ* недопустим* терпим* терпит* оскорблен* травл* домогательств* модератор* называть называют значен* словар* истори* психолог* лекци* роман фильм жалоб* кодекс* обучени* воспитани* преподавател* клиник* здоровь* скрининг
""".split()
#: Words that announce a word: with an insult a mention, too.
TERMS = "word words term terms слово слова слов слове словом термин*".split()
#: Frames in which a word is mentioned, not used: made into examples without offence.
FRAMES = """
our policy forbids calling anyone a {}|the word {} is an insult and has no place in our reviews|never call a colleague {}|a study of the word {} in old novels|comments with words like {} are removed|the {} test from the history of psychology|the dictionary marks {} as offensive|{} was once a term of medicine
правила запрещают называть кого-либо словом {}|слово {} считается оскорблением|комментарии со словом {} удаляются|в словаре слово {} помечено как грубое|мы обсуждали роман, где встречается слово {}|за слово {} модератор удаляет сообщение
""".strip().replace("\n", "|").split("|")
#: Names of groups, swapped for one another so that none of them moves the score.
GROUPS = """
migrants immigrants foreigners women men girls muslims jews christians gays lesbians blacks whites asians gypsies disabled southerners northerners villagers refugees cripples locals pensioners students
приезжие мигранты иностранцы женщины мужчины бабы бабам мусульмане евреи христиане геи лесбиянки чёрные белые азиаты цыгане инвалиды южане северяне беженцы калеки калекам местные пенсионеры студенты
""".split()
#: characters written for letters.
LEET = {"0": "oо", "1": "ilи", "3": "eзе", "4": "aча", "5": "s", "6": "bб", "7": "t", "8": "b", "9": "g", "@": "aа", "$": "sс", "!": "iи", "|": "li", "+": "t", "(": "cс", "€": "e", "£": "l"}
#: characters that hide a letter.
MASKS = "*#_%&^~=?x.·•-"
