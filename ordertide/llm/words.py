"""Words in the order in which the tokenizer model (pieces.MODEL) has them as
whole words, which is about that of their frequency in the text it was made from."""

WORDS = """
the and for you that con with was pro com this not are from have his can all had her but your out they return res will comp one
get she new des und their were has per man cont more would about which who dis them any pre him int import time there like when
some part fun been over stat what work said just into const inter public other def off set our than could also bec back fin did
only then its know class year del der comm people first function how look under bet need acc est ent rec use par want end don app
que act var add mod where pos reg two col may che att rem self every rel even hand should after dif see call make long wor now
through down static void way think again most sub requ because cons right else som str prov true inst name sur start ass play
before pol well err these incl hel ind data good min much cur value loc ser die trans result aut type very own fil produ read form
case spec does here null being car dist pres such years serv made bel list cor det char fam dec many sim differ find inv point
used still while say help cre mon head person false med let show same gener real stud too test day follow take those eff around
going line life using val found string met ver each last got between pass den ask sup try exper number final run never high ins
best sign dem war giv child les los art world turn really happ didn sch cle something cour rep both open come ext old bus must
different system cent private great feel mat home wom includ mem little arg place tem fact thought care put might few state size
without poss expect second next men van another ret post word seem contin three partic mark vis break things file equ lead small
always order won left away struct process support oper ref ein mov von build week book quest mar top friend beh field against keep
non rest dev una term pop since hard soc local direct sure bro current information ide better stand check unt conf spe eas coun
pat tell allow consider team sing object free proble during leg sit key mom expl develop event business prof por commun son thing
power talk called came belie until hum room family program hist mus love effect big pub method game beg school lot took adv cap
light later enough went though group mean num cond given why rece side far log product param prote month appe face less give kind
count stop gover error mil night sol water lim house pay already interest appro throw prom request pack present organ orig full
flo assert cho level body user main super days done view vol tot aff une perform model create ann told text org port door iss inc
asked report chang along change ever occ mind whe important writ eyes desc bit success array following cal four law disc move once
grow conne htt walk init nil prob able mag course exp mit doesn default service within incre understand looked bas job record hold
table offer govern techn prim fore polit times dans air anything sever least cost children path element wait money custom having
moment large either short project including making someone sat company cou nothing net pot typ item young enc women looking health
mult land eng supp mor mill doing toget certain together ident parent possible knew lik exist actually seen control respon bad
often past reason wanted dest design sound plan base says tri invest available och las para meet sum known gen tre experience sent
others soft max market pour saw across print black complet single code bool area require problem config account ste target getting
himself wasn block ant become access working func girl above version example context red cir space fut dri felt offic started
front almost yet trad input camp half cover ben diff mot social stre een based range learn exc imp means wur std particular source
als story begin position special bar pract das rad close dom bed several low makes abs options anal env page distribut food whole
turned response div results represent everything behind creat match situ window message human early quick country due trying live
press specific fall general names sil ener address answ film strong bring woman describ fur city index action fig question individ
comb het major hab auf include qui idea required heart content wer hands mass nat dat probably mer watch cult mother government
pri link near values java white conc stay clear copy provide words pick vari believe ten total ist win inte respect como cut sus
began sort relations father sex ess hom today isn opt whether death miss node color obt crit dark larg elect dam needs matter
rather taken deal period export author remember redu focus character individual needed style hon became dire document visit fac
phys hig employ impro online cas pur friends plus depend hor entire refer hot common pull season invol prop hours hope property
write personal foot research nom instance held members fire history map discuss espec taking services indust expected wurde among
sugg pain five fund treat heard determ sense months everyone clos wonder material gave suggest soon energy easy bre ground inside
status music esc bes host comes future compet voice load neg command pie quite blo claim teach previous site accept exact pretty
image terms search couldn dro minutes grand original coll wall vers della track associ suff inde attack series instead six coming
global necess leave pod deep outside wrong however sem catch http option enjoy pas amount respons myself opp sens students points
cannot length double estab ago bound clean simple seemed age caus educ cell beaut limit date community econom below further comput
ter anyone task aus arm writing lost gre perfect package infl building saying network similar living continue hair dead boolean
client deg step pers round upon resource valid ang phot cam town webs except initial fail benef signific contact relationship
simply longer profess ill works difficult video decl imag forward pict subject running sal output paper eine jour itself million
language buy tried compl activ provided created sich compon uint label received intern road study tour added lower box themselves
cross echo device games role late sold entre dog likely len tool famil draw events software hear yourself liter separ title slow
tax ens pan dig seems morning observ seg dim fight cred office third update especially kill swe compan auto band ple song lat
quality opportun wouldn feet mis tro defined review princip hit perm express indic products media send speak share development
fast particip viol frame qual toward milit various normal phone fem moved store price nov card party percent training ing fuck
complete details led regard recogn exam introdu surpr contr features thinking worked era immedi extra section via gone stri arch
conv questions played natural news chall attempt written blood happened cause brought display finally returned hers dou effort
histor arriv favor handle force national wife capt sleep issue member await sym ign appear couple ship usually ready vill grad inf
loss buff filename conditions weight higher rate accom ways lock etc avec takes political maybe amb floor concern shows answer
ball sun quickly somet issues player parents popular mode mention regular performance website worth correspon alone har ones dru
problems column relig region built install approach fine talking changes protected rele https stream engine avoid terr rock ful
environment prec cases offset rais arr util feature club imm former rights decided rev ment stru attention bis integr achie stra
types comment addition squ considered travel boy playing sam execut mut bal kids financ kept reach bur passed behav ord experi
shall star gun obj weeks serious roll register module applic cook save states empty autom happy jud hat sizeof situation lives
feeling risk recomm potential complex whose modern sett condition fit changed guy hop included sometimes drink quant please
exactly allowed beautiful looks chance wrote nor failed prior hundred web mess anim structure actual flow stuff args album circ
correct lines completely tree location mid equip memory nature gets purch herself sie nel police skin influ mount wood according
namespace published industry choice inn pal aud standard knowledge books companies vict repl sche happen implement fear touch cast
consist sig distributed mur career unique died width lie straight nach stood goes till satisf reading additional bill dos
production population park necessary trust shown lay announ calcul entry items security contribut improve systems policy screen
opened email info float switch assum groups wat hus president definit followed throws fair pen interface saf speed extends proper
driv center middle choose application models dream contract thous direction drive continu gold prep origin rap areas safe
professional temper unit cop format comfort meant active note neigh blue reached closed alt adm frequ independ easily tor src fol
fields yes towards staff station impact directly progress parts plant absolut guess tim cool mouth height board tit hour server
players construct shop connection difference gas priv univers wish prem dies row average named decision solution multiple learning
secret nice join elements emer dep shot platform dress official discover affect related spect bank cele fill gives sudd spent
operation inform perhaps surv concl giving released practice graph increase figure glass cat cold streng dir occur measure sec
argument sou moving prefer breath physical positive sor depart remove kit meeting parameters involved prevent beyond sudden truth
eat provides session convers continued protect pow distance sequ wide cru select pattern green waiting immediately sen edge mais
education associated poor bud auch files leading obtain onto born maint recent described beginning huge aren ensure pet management
background excl eye rom stopped thread stage although eight description surface charg collection users obvious century article sin
commit tra nod mort administr military throughout impl uit unsigned threat court currently shit buffer sont letter href lack oil
properties random brother piece technology transform psy god voor filter includes wind ability numer goal slight numbers receive
root summer methods places capital evidence functions counter arms feed acqu apply husband killed earlier setting ded ran
financial nearly dur machine symbol walked international release starting bei parameter kom fue reference aware hol demand veh
notice component analysis effective legal located scale wants wel deliver deb sister aux cab lif culture whatever designed repe
charge insp customers daughter opin seek push nav burn opportunity pun query mist medical student lov altern returns tal theory
reported meaning offers templ picture async stock internal demon laugh kon ideas candid campaign bul countries expression
certainly connect android oppos firm brand cert amaz pulled resources agreed treatment train spirit broad shape doc tag meas
exception interesting useful bottom otherwise agree significant channel enter contains nation rules quiet thus compos inj fully
reve collect celebr paid fif uma recently heavy rule console fort gar interview anc mask concept selected ele race steps street
birth constant knows cit pair finished master twenty fell central mes allows gro stories baby einer movie hous learned transfer
commer hadn estim danger distribution token epis assist purpose strugg shoot loved click reserv spread miles successful growth
church crow blog computer mir multi gru larger compar drop dise effects girls uses warm zum follows whom wild sell lean served
north mal characters zero kitchen restr fresh shift specified params degree zur levels sea therefore rat behavior undefined
appeared credit habit society encour paint developed images font transport cup extrem doubt chair trade nicht parte caught doll
harm guys movement statement seeing haven primary civil button lived watching skills scient agre tend ahead leaving south consum
activities sales fix jed spot manufact college driver definitely spend particularly hell pool clearly fixed challeng standing
mechan durch dell raised weak scene ton earth strength remain customer interested coff farm activity rout jun married fat kid
offered construction earn brain fra sitting understanding plans older pressure peace shut highly unless ren core clim callback
shared village restaur organiz werden bow basis aan smile scen accur calls basic settings weap radio helped jump tick growing
increasing sets advant reasons supposed delete aim tmp dei limited greater surround telev equal exerc lib damage none evalu norm
adult hospital recommend aspect rac football luck sein rot corner appropri tele prison lic vel rank existing trip ris define heat
convert exists tempor arguments supported coord achieve alla holding fing bag economic showed battle favorite safety destroy
organization seven flag doctor variety tom mine describe science investig demonstr objects han comme presence pel detect rich
classes expand pages download stress compared ses roku established generally fle removed mix becomes watched gather produced
border din script actions mas filled king ven predict lui powerful lose daily ring arrived license proced flags families brief
creating clients amazing sind covered sand murder bright trav attribute placed cos attract parse belong calling iter url evening
honest director solid phil worse vor experiment happens patients rend wed anti forces phase template managed appoint stick
suddenly insurance tamb sac missing sua thick operations deux odd reality teams cer cloud requires writer thr occup eventually
conserv dry sexual costs forms tight partner thank guard emot individuals optim factor smaller contain announced rob flat unter
species este mission journal einem projects serve opening hur programs tools bath coffee alloc ended manager leader traditional
materials msg syn produce storage marketing mentioned negative easier novel carry broken trees emb route listen equipment matrix
conversation minute forget telling independent cin hash generated psych entr assume solutions faith digital excell carried slowly
owner gest proof nob liber hij vert district realized render interpret slightly studies rid benefits asking vector forced sky
strategy neck wie sweet temp foreign hall maximum tip seconds stack raise soul mad concent stone transl vac sounds helps req
critical seat upper explain dont approxim grab sources rub rain truly joined spoke walking nodded sample artist responsible caused
theme hung spin latest hurt rent sites obtained completed sorry fab schools scr incor spr commercial opinion javax connected
adjust planning fant tou thoughts apart trou appreci score neighbor configuration strateg workers mostly finish stars inner ther
smart sad gradu chem instr sobre spring nur advice ult increased finding layer selection polic database byte providing metal
establish eth gal ice dal principal remains definition attr signal sel volume cache wird election overall editor cart camera fav
errors auth apparent presented remained wet despite mobile labor esp expert flex profession pil applied bytes trouble keeping kick
corresponding library json comments award bought extremely minor buf west largest container temperature reduce foi bod nullptr
dating chain fan determine wear appropriate goals hate zijn implied prove traff intr dropped werd separate tab hotel vir els
imagine prz fucking picked bott failure fer purchase bird consult header sight profile female wid stret patient dut majority
believed oder sle sequence pieces kne absolutely electric river healthy extern coach exit shoulder jobs sale determined anyway
records corpor intellig driving marriage willing micro lift architect prin runs army cry dinner fingers advantage variable medic
male circum internet lab loop pred consequ balance gift drug cash highest performed closer becoming prepar vote impress employees
einen smooth snow purs voc income operator equival password emp hidden split square audience bon sick horse benefit cro corre
guarante explained ont reports citiz decide domain reflect minimum legs smiled pure essential observed ctx rates worry relative
seu nie shook advert batter signed prepared supply trail fish units category ble override influence adapt vision thousand disease
challenge motion whis leaders colon suit views appears zwe leaves enh dit mental decor vent boys agent iron components fre tests
assess weather relax excellent showing grew yield strict vehicle chest officer ear journey divers constr sust walls entirely prime
protection keys spl clothes fait introduced indeed realize fro poll prev hyp ideal wine possibly putting riv wearing thanks sport
glad afford identity parties drag mai knowing regarding animals extension familiar liked enable ped beat exhib collabor quarter
virtual testing transition generate native elle hun proposed efforts intent protest holds detail noticed requirements cars kil
experienced remind devices pictures tut impossible rail feels accident notes discovered budget guide incred wave restrict mac
generation ordered literally density gain panel nella previously trigger kiss solo famous thro starts discussion truck critic
propos batt innov crim remaining windows vide san rise delle rapid entered laws photo applications arrest federal usual raw
capacity cards dar comfortable enemy updated defe tout freedom traffic alle depth sides artikel narrow gran noise fans mach prices
categ decre menu communication nuc afraid animal turning lots rose helping winter investment fly fighting religious furn surprised
replied insert pointed messages plane television thousands cris delay nombre skip tur wonderful scope manage dass recall relevant
apr motor factors forest municip turns disappe somewhere teacher respectively alive pou changing afternoon orders sav desire cmd
eating rough sports weren noted twice anx elim speech condu advance tail leads saved uniform businesses warn agreement perman
containing strange stupid speaking manner formed lit economy chosen confirm billion illustr ban worst suggested cant align hen
initi garden secure extended passion equation occasion poet adopt centre ans applicable visual okay opportunities shel launch
conven cette hook dict fellow philosoph adding clin fashion broke reader payment lips academ zone proceed shouldn cancer exchange
photos tiny gent cells concentr totally ourselves island tells variables intended plays cultural scream replaced abandon neut
crowd escape biggest transaction plenty mel motiv mock surprise attend fond understood competition soldiers east accepted monitor
pad pushed replace ride matches experiences existence thin magn wurden teeth unknown homes entity compliance focused identify
offering busy concerned brown egy topic trial weekend nove lett promise conduct maintain boat opposite orient suc exercise
efficient tradition conver terror invalid wire directory egg wealth hide ital massive extract bear links newsp visible reserved
roof witness trend musical neither positions officers violence remark sed photograph letters invent songs dust cluster reject
wedding grav listed chief expensive recon properly anymore taste talent moments extr modify domin plot cities nut nodes examples
stated dangerous linear dop nou claims crazy representation alternative doors appearance silence ignore colors virt remote crime
creation flight vom repeated roz builder contrast joint external bits senior recorded tall sono anche relation bedroom magnet
feelings torn relationships proud twe waste reduced forgot bodies www sufficient dollars talked bond lights thirty respond heav
mixed desk teaching maj nerv coast beside schedule recover steel processing icon algorithm ancient combination dram blocks succeed
oblig estate liqu pob dad distinct subsequ whisper crew lug tea honor gew setup blank pret anywhere excited warning processes
youth dogs oct nine importance carefully decisions pin crack vast faster institut annual episode delivery typically intel gonna
compare apartment rul obviously stepped ast permission studied accompl loud happening depends taught attributes dess houses reset
bien explicit mail authority unable sector hang cel cheap enabled division hier limitations studio circle laug laughed ends
fundament inher liv responsibility checked fault yellow salt beauty magic handler numerous hole rooms buildings plate dimension
blow rect passing finger younger storm buying damn meg silver communities diet bat fmt til matters complic dance permissions
warrant lad isol provider terrible department implementation hearing diss durante tasks branch politics leadership techniques
creative narr winning latter requests margin allowing combined instanceof pero confidence equivalent lang bridge treated forth
accounts listening reform gate somehow layout considering premi planet premier simpl segu tables sous conference standards
citizens occurred democr elev formal organizations pray bomb mand clock buck volt films plants restaurant debut wordt greatest
copyright rit bigger perfectly ett nose craft discussed lunch paying rare unc defense gli loan spending sugar advent hav conscious
symmet posts chose missed pul advanced funny eer veget fourth grown beneath shell religion vez welcome jan cycle acknow wound
possibility technical fold reply decades unf imper bug depending policies signs publish recognized relatively specifically grass
causes weapons sir schedul losing jako successfully friendly pregn binary stared circumstances analy alleg selling queue seriously
candidate minister barely sty documents debug contro joy protocol faces evolution tod posted rum behavi dynam scheme proto uns
remembered incorpor prepare automatically sharp meat stuck planned reviews answered sau identified mol committed interrupt
readonly tent amer lady tired aside bringing reaction absolute tone wheel administration interests pointer encounter nord beach
enjoyed append squad medium sending destination conflict vul basically calm dump claimed blind tough sept skill fee continues kan
cha essay suppose comparison challenges papers shock dedicated correspond bull figures favour nearby perspective nos plastic angle
commission funds indu drawn developing segment lies api scal gentle dialog articles leur stom stead prze draft stayed vot fabric
reput audio gap streets scientific auss partial choices heads weird represented owned typeof neighborhood resulting shadow videos
goto operating hundreds emotional fasc laid rig detailed implements university grid regions slot angry waited elem ratio cream geb
factory governing jest emphas sul historical lying measures pocket pitch natur humans expos apparently spaces acting fruit trait
artists absor movies dynamic smoke instrument fuel serial bathroom tips capable tak represents consistent begins edit mountain
chapter wondered industrial ges directed nam league exports sharing guitar confident hors shoulders kinds purposes owners chat bin
bread compre shoes raz trace procedure hero marked worried serving disappoint pleasure judge forever waren flash troops drugs diam
justice officials tomorrow nem hardly loaded fool trick dst framework merely union crisis finite lol compat pert teen sympt
originally throat attacks hes incident bij ber silent pier plain pill carrying resp typical gau chemical hal relief frustr stores
bottle cheek concerns helpful coverage approximately enum evil constantly practices teachers substant mob ingred intelligence
thinks personally trained survey pag boundary quantum drawing volunte swim revealed explan gotten falling contained killing
aspects resolution boss debt vid uno finns somewhat actor probability chart stands onder boost desper alert suite vacc proved
moral instant milk forma frequency assumed smell aqu axis resolve tears bother registered revolution versions noch charges math
manifest attached spiritual seed magazine eigen alcohol millions chunk launched wake guests differences aid beer yards technique
hoping victory significantly practical expansion extent pued gam sevent colle stored lip aug sole mehr interior shopping brings
propag admin props affected degrees nin interaction scatter duty answers vie depos packet tow deleg vary migr metadata anger ham
frequently charged accurate derived seeking trem columns injury headed climate fake pit embed strings goods optional recognize
careful locations structures disk ships suo sowie reasonable formula residents trib stable breaking meal phen fel capture
everywhere sque moder whenever toe frag contents agency cancel superior literature basket conj seiner confirmed struggle moon
struck weapon subst instructions occas batch contra deck ignored refused criminal prefix immediate assigned elected tonight preced
galax logic facts combat explore locked disabled hatte shout constructor tras adj exhaust scroll delivered referred prospect
modified excess tank guns mainly effectively resident flying mayor colour aircraft keeps shirt gender butter classic drove reward
hyper entries prompt painting formation disable rein resc patterns hasta installed visited desde drew aber dan expressed supports
commune printf dels recommended founded markets destroyed abstract serie portion integer returning settled therm cig investigation
retail drinking assistance intellect admit matching genu verify aussi suitable indicate tracks hasn closely limits moves channels
trading facilities sys meta estimate guest nobody darkness extend burst repair fetch chap promote samples constru universe
preferred dow experts naz distingu seine fairly authors edges shooting maps linked ske powers stomach usage defend sustain updates
assign discipl bunch agents glanced lect patch vit harder desired jug supporting controller issued affili partners priority
declared browser grande accommod suffering logger breakfast boot contribution housing brit broadcast tar delight emergency ces
situations familjen march fundamental academic rising receiving judg necessarily deeply gray coal profit advoc agric arrang
flowers ihr mont btn besk acts curve cleaning regional estimated threw awesome rows foreach routine pic horses requested lifted
myst improved duration timeout lux trab inspired enhance lucky facing appreciate bench tub lors mistake paus subs stato gay
vehicles brill wore diagn holiday achieved bra cpu occurs nuclear surrounding prima gegen thrown pump solve negoti sans edition
spectrum execution cow readers consumer styles execute visitors trop yesterday increases dalla strike recovery strategies rear
adults cui ale peut entertain parking funding cancell feedback pand mirror verb highlight grade implies enorm machines dent tid
mole cutting tong networks sheet yeah candidates rolled professor addr fired sql hence executive liquid driven copies tan pobl
southern zwei concrete dreams minim employee nap suspect therapy mood shr decade dot hill corporate appointed embar pressed
champion urban sentence regularly passage largely connections surprising strongly sist extreme dealing granted upload valuable
suggests jur invited deriv instruct courses fifty hip tensor consists normally padding puts giant victim attended span maintenance
bind convent poly idx asks enthus suck symptoms html furniture lovely finds esta cock puis announce guid somebody compact
organized roles hint pays hoped sail embr bot exceed gaze spons torch newspaper bass hanging ears unus dressed parser sections
metric vice nue collected mond nas abuse sees arbitr magnetic newly reprodu writers headers schema labels equations medicine
authorities environmental conn uncertain belief featured touched tact eines przez fuer exciting versch naar territor wrap crossed
stim signature decent faced resistance interval explo semi widely knife todo guarantee vital fought anticip proven partir wooden
provinc memories battery compens quad coat fir coeff peu parallel institutions atmos brothers wanting fest forty creates leaned
ultimately tok lawyer facility likes entrance innoc proport arrive pairs wrapped unw explos gel legit illegal tort pron forg
discount poster northern naturally drunk mouse continuous initially recording correctly debate permit professionals handed
beskrevs anxiety heavily dispos operators votes feat western confront stronger nad checking birds intention covers wondering
aggress dates bom scan everybody unexpected divor ease pale pens principle letting conducted measured indicates ending encourage
efficiency diverse wallet earned fees pleased suffered participants legend handling tap assets outer blev sleeping warranty
domestic searching underarter approved compute ridic conclusion controlled birthday lin advertising resid inline informed kter
documentation regardless statements attitude whispered privacy persons generic paths pap worker pink donde tags loose reputation
rif county comprehens transformation fallen sink quel temps ghost supplement dismiss closing vulner overwhel disag stairs eleg
veter franc yours joke annoy rag cual solar taxes facil sought bare react crucial museum bike admitted spell vic proc acceler
convin clip plugin pra opts slip gang dying vec layers tied alors jou chicken permanent peak dear introduce causing pare breat
commitment increasingly statistics gle wieder instruction blame listade aapt gear burning complicated tested staring survive cous
rib cad mapping twelve grant thorough folks childhood finale shower spat pes engaged vess electronic privile novembre controls
categories emotion cooking attempts ordinary avait illness zwischen hardware sounded piano bab reliable declare accord mars
meetings accuracy autor ainsi eing upset explanation civ conce promised clothing sizes banks instances alongside renew asc waves
pom grabbed surgery restore analyt shares manip essentially casual engineering reaching oppon myth worden assault dual inches
personality scar regime noten rural disput aver obst shipping classical constructed referenties captured minimal sock equally
reduction argue toler primarily algebra gathered recipe scenario yard stad validate committee temporary consequences displ apps
adopted femin knees exposed sword boxes cuando pilot desert loyal asset mud secondary cul staying dataset loves velocity purchased
competitive knock vend arts dirty websites ticket implemented bowl alter accompan doctors ingredients calculated leather sensitive
suspic anni abort vertical ville diplom bars stir primer vibr deeper termin cub jew captain divided extensive suffer heading
quietly designs enem arc synt succ tack awareness hug contemporary dozen cheese radius dimensions adds household casino objective
rug severe toss embarrass appeal forgotten kernel carbon quote mini pipe nous nervous peer satisfied pulling mile supplies pace
ought viv mountains fragment settlement drivers impression infer enforce cried begun visiting targets diagram partnership
convinced cot repeat lists royal grace oraz arrival fantastic convenient overs consumers wing atmosphere gig contre drama
philosophy nurs sud performing confused checks degli architecture ptr dieser topics principles tongue percentage dol rice
recognition caut conversion surely gard urg absence winner translation emotions flu operate partie golden foundation neighb
scheduled observations producer expectations writes pushing seats breast socket slave assistant trim landscape association sweat
curious replacement calculate sessions typed submit partition shru cand particles approaches casa fifteen potentially seit
acknowled ownership describes reverse contest scored opposed merge covering honestly rarely incredible victims przy payload
displayed ocean attractive fraction behaviour revenue tres sync ancest gained momentum bonus texture languages representing
contributions ric electron ell threshold concer bone awarded summary stell flesh quart indicated listener foods notion employment
swing pounds participate fost publication rapidly experiments naj interact cms outcome hits spark verw soci dining tech pros posit
coinc references cada gep bron surrounded nome underlying educational mechanism acquired falls vertex marks energ engage mant
improvement arrested cycl neutral dip opposition borrow avant guilty buried accomp breathing subsequent precisely folder revol
discrim ave gently dial relie stats grave recip naam directions tum saving territory sne fails introduction vier advis gym protein
providers soil dispatch bere studying fright compr wash accum fiction lap whereas appointment radical exclusive challenging vida
campus intense controvers landing scenes spoken pride meter deutsch bless inputs withdraw airport chocolate alarm sake
registration lake username hack festival clubs primera brilliant difficulty scores acid reporting nights programme spo serves
environ crash infrastructure gauge jet commonly stations cabin shots hem singing accessible canvas addresses xml kar ages choosing
burned dish muscle scared denote orange hub reb voices suspend scrap aggreg riding breed concert chances scholar login soort
functional subjects extraord timer athlet heaven experimental bounds excit quit universal stub kle selector coc possess unusual
bags loading cursor paused counsel tie armed observe permet eggs incredibly painted violent spir niet involves organis depuis
restaurants baseball algun employed integration risks stro agosto stroke deals sab screw inev separated packed province expanded
approached ore impressive shame council shouted wis stretch tries disappeared crusher dopo codes powder roots constitu figured
assumption lessons qualified reminded membership cref phrase pse tournament refuge elsewhere abandoned delta flour laughing cake
crate amounts constraints temple installation obs jusqu modes belt pointing persu legis utter irre familie ciudad technologies
evident steady monthly applying minds kam expertise notification deliber resist presentation rust nations responses reveal todos
ade payments platforms lifetime cum appl argued synchron jumped contribute polar trois gaz lung fifth involving sull interactions
difer liberal particle surve depression flower waar hade centuries approval marg monde ook theoret tun roads rotation composed
virus opinions horror statist gem secre strip dirt discovery substantial demands everyday besch bulk gan talks scientists vig
quantity movements assembly happiness leaf assessment attorney geme circul pent mate sons investors panic detection simultane
listened abund criteria chip mining worship downt holes grateful consent colleagues enemies fluid scratch validation completion
explains anybody sang passes entertainment grat printed deleted manufacturing rely conse fishing clinical evaluation attacked
frozen rational alc hydro mie offices jam decay marzo asleep soldier contrad wins seasons healthcare worldwide responded
procedures cleared deploy ongoing bones shrugged initialize hire tracking ash ceiling courage folg reven disp defeat creature
steam ignor proposal weiter consideration believes circuit singer astr representative comprehensive mere continuing sear enormous
guerra endpoint lesson researchers attempted enf defin awful lowest unlike producing faire maxim ram stages tang ich dependent
exposure mart prest observation commands eager outdoor puzz kennis regarded fois optimal subscription legisl branches sprint flux
shield unsafe telephone unlock snd suiv entering quando fed pregnant ersten retired erh composition permitted pending agencies
klik rating dumb rolling bundle golf cls badly immigr waters joining redd converted prayer elections narrative wand wished
detected municipal grey voy lleg currency expecting tickets bucket jacket loans kann integral characteristics manual dynamics
toile distant handled penal prominent exped asp entitled jag rejected memor applies pose rocks smiling efter bands collaboration
engagement wings dove evaluate coordinates flav brands calendar uitgen tale briefly mic integrated cookies uitgenodigd phenomen
voegen refers assignment asym binding behalf breaks soap crying msm boots bell google floating roce bewerken ere camb greatly
logging opens klikken sculpt injured commander receiver hopes byl proxy gall executed ate animation inhab router glob beginnetje
certificate soll pandemic nic roughly specify thumb unlikely periods titles fon bast fal gesch destruction stake identical fog
historic entrepre tension frames muy resolved tape singular personnel scalar cable erst struggling throwing satisfy slipped poison
ultimate flick raising transactions glance gri bold maintained encouraged essere hired woj injuries dil apolog regulations
presents poetry stops tower organic drei pound modules worn parad lands minist lighting naked designer ers measurement muscles fru
genre alpha retirement healing sido concerning variant arranged colleg explicitly redistribute elder grounds signals gifts
strengthen finance cuts adventure intellectual awk concentration guidance filling regul delicious tons img rush pok lid ladies
rescue glasses favourite precision conoc picking priest pist bil conservative sauce occasionally drum dub strategic kap
considerable tous clar poem traveling pharm measurements sensor demanded accompanied prend encoding mig myster physically managing
lev tant fot guards chamber bias bent prohib bid fewer lugar deserve cfg stability lets brut dyn frequent jedoch bos slice insight
widget requirement ceremony physics graduate preserv shops fib runtime hogy emerged drinks instantly justify transmission symbols
corps jail craw lifestyle redirect osc insisted jaw knee defeated mixture suicide deaths listing processed tokens giorn elabor
tiene dirig rim transferred hunting enjoying losses loving inspect hated brush uncomfort communicate programming consumption
communications prost fier featuring premium deze sighed reads automatic medal lon assuming undert flew bol tiem attach safely lag
tempt identifier eerst reson accused basketball perf tempo logo incorrect girlfriend clouds fits ampl realiz sistema beliefs irrit
nouve elif meals closest routes fulfill inequ pelo shortly imagined trusted estimates rod logical compass wise ger rang trap
inject satisfaction robust inspiration analog racing rab nell preparing concluded loro gut bitter eastern weekly tear demonstrate
soph obsc consciousness races mismo occupied slide stiff upgrade puede romantic corresponds infinite wip coin judgment fert dall
rival conform vest exclus bru gods concepts mild supplied capabilities marry etwa grip faint plug cov encuent symmetry shifted
damaged testim hiding horn pixels confusion allem assass beam pela affordable hay cargo emit dawn wisdom fet dens filed complement
intens garage etern denied ridiculous questo determin arbitrary addressed interpretation bou pants submitted cord poverty tile
preparation woods chef improving blink actors survived deutscher sop vil promotion classification cort officially landed porn tard
intensity excuse generations warned capit chop prosecut alg retain instinct boundaries median horrible innovative vacation walks
recalled legislation franch differently imagination bills reception balls institution survival flavor computed viewed swimming
innovation corn mathemat punt revers nowhere monitoring stabil pipeline radi celebrate beings vous wetenschapp secretary insect
encore dude lapt championship seva matched diese fate existed expressions literary remarkable resulted spots genuine sorts
expenses singles theorem operated ved infect dollar buttons metrics participation bio precise inch neighbors cousin capac pause
shaking reducing voting accompany equipped nun licensed engines ster locale alien versus emission climbed plusieurs usb crossing
polynom removal ihre wounded tin administrative conqu cheer encontr smoking bay akt governor sisters revel filters removing
generator farmers overcome shake awards episodes bullet viene rou biologie speaker refr cultiv hungry excitement climb mistakes
shapes gene disturb stopping restrictions shadows fence luxury investigate conventional visits reflected simulation theories
collective coordinate gef electricity gathering independence consequence conversations andere moist rode perd szer flood intim
reflection disaster humor suggestions medi seus innocent caps dramatic shore correlation pubblic ferm affairs dancing agreements
outstanding nurse nucle painful slic seinem satell collapse threatened desperate conflic theater pleasant pir acquis recru
respective tunnel uncle offensive descriptor stones fantasy orth duties nearest disorder seq transportation chin matt voted sue
legacy snap impressed deposit divid crimes insult bounded kicked awkward beim placeholder cogn sout trash decline combine drops
governments performances managers mystery settle backup seinen vulnerable friendship involve corrid jul inequality ain wider jack
quot waist masses chairs citt seeds democracy spare groupe sender prisoners antes diab flexible reserve towns criticism politician
terminal complexity locally pole equality isinstance mater slaves haz wrest llam virtually weights llvm cave geometry weit ads
constraint eyeb mesh cookie nick savings patri multip kinda cloth fleet humanity valley murm especial hosp tanto oldest hitting
compatible accomplish geld lum janvier divorce refuse dimin gross trat autres neat otros schol tube haben blade manufacturer
succeeded backed hearts fraud gaming plt monument moins gepublice kingdom juin uncomfortable dread demonstrated vertices examine
therap produces photographs threads extraordinary gepubliceerd guaranteed translate ling belongs electrical presum approximation
grim characteristic prize indices stem aged internation resume estado abilities brow trends folk ward nest maintaining bloody
dtype bacter gradually indicating decrease developers retr lazy assured industries incon retriev palm stan frances grin tiempo
deput sixt predicted ihm manus instruments counts aimed dok estud piss inaug voters packages cute fitness leurs sorted zip tooth
upcoming precious pile pon temperatures clone eller lun streaming calculation pixel mul outcomes centers residence preserve promot
courts disg retreat bez atom roman coupling railway possibilities kor summar describing verd galaxies organisation bite morph dann
cats brew circles drift surviv uncertainty engineer horizontal numerical reass cod navigation simultaneously harsh vin findings
possession parsed enables orientation comun coron boyfriend inode enthusi disagree snapped sour infection queen timestamp
interviews laughter gra gab mortgage declar ligger brick authentic monster transformed firms catalog diseases horizon lord cabinet
vocal artificial mentre estaba slept endless weakness attempting founder salv compound conve caf handful defensive significance
perpet caller stolen focusing bree occasions actress jej twisted junior juice softly italiano creatures residential killer
enterprise vacuum defect ninete regret shar provision discussions guidelines straw burden spatial stretched typedef robot tel
subsequently honey establishment variation gravity conclude collections ethnic parl paragraph fis posting racial dishes slid
juillet cooper curves primo famille fueron headquarters dign meets soit wrapper theoretical camps amplit servers computers
protagon forehead signing downtown besides algorithms cust mounted isolated orbit turb grupo hills satisfying associate distract
barrel invariant lieu compete couples sei migration barn neighbour odds optimization politicians shelter timing septembre couch
liegt carpet pursue arrow knocked decom pupp cotton theatre acceptable rounds actively amongst abc diversity employer suspected
crypt babies mundo libert magnitude grain mos consistently dominant substance coins exempl synd prot convention whilst cher
reaches eligible cameras discipline silly referring merch susp exhibition extensions phones realm contributed hid metres gram
advantages sheets blocked panels meters rapport pup relaxed defines kissed invasion screens passengers beating gallery rental
shocked kommun hosted mechanical psychological abroad avoir separation subtle marker hover soup availability opera sib fiber syst
spite toxic apro trips plaats convey lobby recommendations overwhelming acquire recur jog nast wishes supporters disappointed
digest aggressive intelligent overflow yields utility faculty attracted mixing escaped drain rings convince prod pig alias gorge
dependence cruel thermal resort pregnancy projection themes funeral caso tissue dragon lig nei comedy passenger labour villages
diver translated castle regia punch restricted grandmother sinc optical anchor reporter vegetables enforcement condem sits
calculations tipo konnte zap perturb refresh flip keyboard promoted gmin followers pepper spray drives geldig atomic attribut nost
maar renov hypothes macro fare horm hosting lattice portfolio oven momento dich entert connecting nacional ott racist penalty
descend belly encountered guilt damp woke salary git octobre janu contracts affair dropping dic dort pretend dialogue publicly
speaks compensation partly useless deter consecut holy graduated foo notable journalist scales erste reluct daughters
manufacturers printing brows ils meaningful familia steep presidential wars afterwards struggled ugly halt huvud grandfather
habits lowered radiation devoted gesture quoted difficulties sustainable dense ihrer firmly cout poi profound flush avril propose
ranks mutual texts quasi nog nouveau noble clever graphics sag devast fluct shorter suggestion rounded tart secrets companion
angular prediction tens forme lane stag dare pant cops rushed initiative invite habitants quatre pendant rifle boards purple pills
populations accent ranges dictionary visitor identification surfaces screaming jazz ion newspapers ihn strictly recovered erre
expense donc sacrifice travers curios rage escal alignment pentru curr beste lod harmony zich edited anderen spectral importante
stere melt satisfies tomb solely tennis sigh squeez finishing lover paintings assumptions modification toilet ange sheep backward
realistic fancy laser comic expr editing helic stranger exec complain increment engaging lens barrier cups constants improvements
hosts espa emphasis recurs deny doub blur anxious stare hex arrangement boats slots appearing outs variations whites glo jury
treatments profiles conspir classroom lawyers sla attending bored appar jerk handles jak boring shade plates cheeks apple sod
trains cours makeup aria mature moy subset eleven fortune entities ordering strlen rope cigarette photography cultures declaration
rhythm intersection mog threats sigu shed befind ost emails adapter padre genetic acceptance wheels thoroughly ella politique
campaigns albums laptop fou corners specialist namely scaling centro contrary striking forecast zones simulations assh failing
manif influenced weigh inventory apare orb proportion approaching inhabit traveled offense incent coefficients sooner ranked
partially cached balanced ali bark allocated cens licenses republic trials exem advers keen bitch embedded counting verse anth
hunt swift temporada environments bew harvest isset determination emerging bronze fitting contacts firing profes ruled ensuring
reck dock latach segments refund recycl imperial practically highway retrieve dominated accomplished fears seemingly dag bureau
accordance colonial compassion swo workshop lub generous swap garbage fatal transparent bearing celebrated prince convenience
mattress invisible claiming notamment ink surf acknowledge lawn bases exceptional quien bullshit dragged cyl dose suggesting plac
arrangements ath ents fucked repeatedly heating modo tanks elite targeted lou dried fixture profits dispar intervention
functionality wrist sta guerre novels snapshot triumph scoring absent replacing embrace overse carrier poco cheaper sophistic nah
varied freak europe bust neuro definitions forming classe bottles titre straightforward opponent generating patron grows acted
planes chronic washing spirits recruit muj explaining gouver punishment vectors banned touching ese barr divine aest circular
mascul designated breathe involvement publishing rubber pint progressive zusammen battles massage adjacent chi integrity bras
chains stunning poder clusters forcing poured mint wherever stair blend feeding kur protecting volumes galaxy saison eliminate
sufficiently tremend critics representatives havia aims grief categor educated unh elegant abril accounting predictions charity
thrust tender endl inflation waved departure promises hopefully folded placing discussing occasional autre passionate citizen
swept popularity acres certified chron authentication nelle utiliz distinction overhead pont transmit indirect bek nursing palace
gambling doorway tren dere ante praise crystal hammer insights brig wealthy pizza restart jewel sixty worlds haul celebration
popula twist ties trag stark glory phenomenon agenda quotes churches analyze expanding steal affects distributions trunk eran
vocals presc attrs propriet skilled qualities causa prosper literal coup volunteers augment dys fled strain processor parliament
notify tym investments exercises medication posterior sixth trapped manuscript speakers climbing awake volta habitat stata mold
embargo helper encode exhausted grandes pressing ocup venue slope gol configure consisting artistic magical immune defaults aws
exceptions farther stor celui venne legitimate unem spotted disco perception streams holidays examination whist sends pulse sulla
uniqu displays announcement scattered experiencing tuple heeft chaos bail aston franchise advised stain shaped islands symmetric
foss bereits cri ligne oxygen underground wage delegate crypto oscill males ritual sacred vessel conservation ensures fprintf
anniversary durant venture backing ware recipes minority nar reduces examined gradient beds intu flows affection ports lamp
beneficial lined fitted verk focuses rape togg jealous repository skull switched beef appearances zona neu operational hockey nuts
leaning oral essence worthy hood empire probe peaceful silk pione buzz washed ramp kun vaccine census statistical tropical magaz
computing floors titolo anci metall lookup carries lut dull thereby insane mysterious murdered anos volunteer reactions purchasing
embod altogether promoting induced eerste chill tune ray suspended upp catal hiring exploring universities escrit corruption chim
capability retry toy vine ratings heal traged chuck wireless junto sid comparing celle obtaining quar hind receives american
bubble demanding credentials structural blanket repet exclusively arguing frowned releases tast preference crushing coaching
basement portal troubles denotes importantly relating ander grinned holder trailer decode counted vamp relate titled participated
matrices forum sphere volunt stellar configured delayed ging scent disgust reign dozens biological corridor suits divide beta
exterior finest freed fruits servants publisher copper chairman mothers jeans reveals unconscious hacer canal equals allocation
motivation fires heute warmth welfare seguito yoga dug restored ranking pian gates implicit pac scattering allocate interrupted
sto identifying pid digit shallow advertis secured relatives sob stab wen kont hacia antib merc poc purely gorgeous romance dav
traject arise swung pockets traditions rever divis beloved quantities talented immigration juris aer eaten miejsc summon gains
restriction bout slavery computation armor cooperation enhanced abrupt podcast hospitals hotels thigh tends delet popul diesem
empower dealt estad credits physician gob kol cared oficial jel rapp stocks developer placement lavor accus sketch sentiment
rendered laund nons blew commerce dre twin dedic differential feared invention caract delicate rip obra banda kole outputs dated
spy crap incoming observer upstairs atr expectation argv earliest patience buyers adjusted ruin comprom encouraging beans
perceived globe alike hurried musicians underneath females peers ski butt similarly inevitable beiden august tatto terrain crop
fist zoom ruling gibt raid freely python diagnosis chips comparable analys peg voyage crush bekan dressing solved sealed reddit
mour cleanup unfortunately siglo kin genius europ fever satellite bild documentary grasp dla readily cooked annoying dai sacrific
servant skb barg coupled portrait dental destro rue hybrid solving lista fusion complaint approx vet kilomet delivering
constitution probable runner overnight objectives colours lightly scenarios quarters luc appet deport menos caring electro
december colored consecutive dio toys miser governed trivial occupation lav mou bord artic mientras commented triggered punct
achievement porque triple secur handsome dod kilom belonged proces tales spreading sched cater tire porch brave explosion
classified separately banking elf employers juli analyst harass angles llev nit wreck patrol loyalty nationale dispute rus
democratic miejsce tex developments varying creativity provisions outline cares fins heap smallest attra selbst unset homeless
inhib appreciated stays alleged coding accepting curt tightly unnecessary avoided poems ker charging motivated aveva flexibility
racism baking attachment bajo pricing bibli adapted collapsed chez otro teil investing aboard flights genuinely promising suoi
sequences cure gardens inspection regulation immigrants elderly cosm ignoring sensitivity engineers correl inherit midnight esper
notation invitation essays confirmation tray reun peoples charm utilize distribute gotta blocking bonds dice inspir quale suppress
crowded loads correction cooling betting implications poz regards amid habitantes jar requiring liability lyrics statue heritage
dorm lever muttered intermediate viewing toute uri exhibit asympt lately defining febru sempre clearing diameter soccer nomin
directors moderate treating fino stamp segundo inverse dup broker searched jego discret navigate disappear congress graphic seal
cement keine continent jaar crown intend bub masks situated participating preferences violation christ primitive ranging substr
closure przed merged jer defence beaten intimate productive klub pseud quelques punto diabetes personas nep frustration sprintf
bore agricultural heels vessels ende winds equity collecting lifting winners stesso altri producers idiot fos encuentra screamed
polynomial cone cited presidente resign yelled reli amen alumin shelf logs regex punk borders flaw cinema abortion ours magazines
locate desarroll unm administer gele drank ensemble champ trump modal sunlight curiosity relativ persona wides consolid
interactive energies independently absurd bund scholars marine trucks rewards inherited extens glow evaluated ops cleaned dece
contempl acquisition sectors trabaj txt immer distinguish privilege delighted deployment contributor threatening declined withd
tossed jumping manually sap fascinating byla invoke consistency exploration foram compliment senses clas highlights dessen skulle
overview blast enthusiasm characterized spectra honour phases surprisingly dick sexy iteration infant sofa devient spawn cattle
styled roi urge devil germ januari thy halfway encoded sore orden allies competing angel screening adequate vag wyst kwargs
compiler mainstream drm erhielt vain mejor streak sophisticated cycles medieval missions sampling dismissed judges locals dici
authorized keyword entrepreneur acknowledged tourist gebru anonymous tours lonely reviewed nerve decis spokes qued opponents
publications remainder collision workplace consume avoiding charts sheer angl campo lecture lasted discrimination diagnostic
giornata picks representations countless clo historia longest bef mechanisms heter athletes periodic maid swear wiped graphs
thesis sensation deel discre respected fram specialized complaints disse consumed patent visibility cyber inclusion manera
efficiently formats ministry fonction caval hely admission css booking bland submission distinguished arrange aunque inserted
tactics tram parish contempor desires miner qualify derni relieved indent flame shifts caracter frank aligned shy particul
hypothesis lemon abol sia consid circa nuevo evolved hanno closet stride epid attacking vita stating envelope volatile toggle
defending refriger parked lighter registry testimony compiled hallway norte phr convergence valor sha modest proxim edific queries
pine beast determining junk creep nan portions guided ace imprison unity mayo faded widespread catching cere penis brutal hed
lease equipo irq sentences haar households unders accompanying epic copied psychology epoch aunt completing presid nested archive
effectiveness incorporated toujours aller souls interven schemes witch merchant spher addiction sciences registers penetr
prescription trunc recipient grinding naval selon districts shouting sect dello fighter divisions exponent jokes substitute seam
zam frightened otras tijd aur czas tackle pecul preserved comprend datetime mondiale prow belonging accommodate damit shitty
believing inhabitants tremendous swallowed anys deadly scary secondo heroes veteran behaviors spectacular demo serialized
meditation coefficient adoles clause delen suited backs propaganda forgive operates lingu collar shoe legally builds quer bacteria
magnific prisoner surge warnings quadr adoption wanna derive arena fils attraction nineteenth maggio dummy tob stadium wolf neces
overseas corrupt november interpreted wages registr morte composite iterator initialized poorly otto strikes conflicts surg
historian libraries fict blessed fork negotiations genus controlling indul ehemal amplitude photographer invested prolong carb
neur corporations deliberately febr provincia indication pistol rund sehr eighteen tug organisations genes todas illustrated
arriving excessive traits sank dentro atoms distances bekannt conclusions passive stagione desperately verl cob lasting elementary
pov evangel likelihood breeze suppliers tablet zaw subm nouvelle strangers sanct backwards backend deemed accurately transc grud
shifting mentally calories consensus objet elaborate snake refres reflects pied expedition utterly breasts hunger verschied spraw
mechanics remarks painter haut veloc compte witnessed gren hurry sar lambda hans answering olive spont intervals triangle rally
realised earnings april silently revolutionary chrom anterior sixteen throne audiences ihren kidn zak plat scientist hyd tier
establishing indicator spine teles packaging productivity degener dough clue meille tendency relay designers bicy alternatives
countr slim tir doit concentrate negl taxi dia irr urged anom tarde seized deciding listeners planted vendor measuring necessity
rivers laboratory reproduce notebook reasonably revealing conviction alternate canonical influential bolt cerca decorated staat
competitors diamond mobil clinic ego fract pets addressing mens ersch communes commut voltage fame casting engl intro clicking
flames randomly parks murmured reasoning ner meer typing happily equilibrium desktop questa consisted hesitated wenn controversial
lac anch cler challenged seated smiles cracked imposed protests wounds secolo founding retro potatoes tilt unters impat repairs
pagina obligation persistent certification skirt discrete teas audit whoever inferior leak companions accessed posto pursuit
grocery normalized trauma autumn sovere liver gentleman subur bog ceremon outfit agriculture django tecn bean buyer bor settembre
wives marca descent consultation erano lovers virtue viewers overlook crist provin tiles argc templates weitere toll
correspondence tam molecular chemicals rendering decides apt affiliate revision fiscal dependencies rack prv radar vivid likewise
mysql cancelled rebell composer deserves ohne practition indoor configurations meth blown deven stam plugins travelling autonom
considerably ladder hast sele anticipated elseif filtered auction sucks femme evt russ petition bears hollow complained mapped
initiatives owns dispon mush erfolg cet stalk extracted accommodation intentions concentrated utilis compris rated peque unused
emissions civilian achieving openly stagger guides principale ruined sliding octubre boom activation entertaining protective midst
trouve greed suspicious deputy funded tract statt fights prototype lungs dive diagonal preview britann farming kills gaining
noting syntax retval simplicity reinforce diffusion disorders helpless compression upward bride isolation regulatory salad
conspiracy batteries attendance aggregate destruct fourteen bothered mism resting idle deren diary vague marginal earning endorse
beard neutr ambit verified descriptions valued chapters clarity tourists tribe advocate rigid congreg startup deadline begann
calci incons rubbed synchronized unfair societies kat poker locks reconc bleeding derivative crushed temporarily coaches creator
seiz dimensional preval determines imply toutes eternal bankrupt failures tcp containers conced septiembre faz pip lado
compatibility mare chick organize economics ancestors scrub labeled switching giugno charming bugs lightning nevertheless lengths
tragedy abundance evac recib foolish despair compromise investigated exclude televis pulls accordingly rhs formally september
treasure disclaimer selecting porte assure frustrated escort bush bend jewelry arrays shaft gennaio printer damages cav
technically tricks needing rehe reminder shiver struggles genom gloves inclusive renamed compile draws nail transit compress
purchases performs demol commence cush wir refugees introducing scholarship departments numpy projected reminds slower detective
seventh adaptation jours supers accessories distress goog farmer asshole molto propri algo congr chemistry animated drums programa
nej anime needle inclu bour stepping neural ubic facilitate nag worm spouse survivors cognitive onde enabling societ clan excluded
thunder entropy fastest flowing affirm hips cannab sticks curriculum retained extending jeho forests rav continuously ambig destin
commod garlic dramatically twee youngest cage amateur disability revenge courtesy blob prints proves utils terra mineral warrior
safer comune hierarchy mercy sustained dealer reporters peculiar supplier rolls preg surrender contributing decimal terrorist
pillow grades numero centered rhet laundry estimation wholes constitutional publi dicembre idi appel advise anten broader junio
wool hatred exagger emperor feas jsou chant associations tires dash invented urgent detector altered membr nutrition enumer mines
litter swallow deutschen domains candle plural sharply candy kilometres powered sep suffix julio provincial appreciation cricket
torture outbreak preventing madre retire fais remembering arist workout paste otra nau sera proposals tenant emerge gek witnesses
watches careers faithful recommendation origins spinning bombs contributors nasty drap welcomed wagon embarrassed enjoyable dashed
exh wsp buddy reste bald chase homme squeezed possessed attributed prospects surveillance cryst intimid resent alliance pode
responding blowing civilization conscience updating militar pseudo behave distinctive journalists spun durable proposition
twentieth selfish decid psychiat ids grants lieutenant accepts systematic ausge dialect mistaken utf urb cough surviving sway sog
newer exemple litt fick clay homework enero compelling tribes harmful mim scripts assembled toast tutti bezeichnet regener toda
ethical workshops impacts portable relev combinations rejo traces opacity emotionally legendary pam ensuite helmet territo segunda
invoked compilation influences tucked pension generates incap clicked fus obligations expose guessed formerly strang elbow steht
damned packets elevator remem entonces vas sympathy befindet additionally musician listop carved nicely modifications balcon
dependency vanished fighters defens curv gratitude juni immense prevented foam incorporate wasted complaining warriors conten
machinery technological gras minimize bzw prac fade footage entstand nails capitalism suspension infected therapist cidade pdf
bump handy temporal lan shining nurses betray sensible thirteen recher dernier maximal ultra tegen baseline kall brains hostile
marble andra documented wax diagnosed seventy noviembre sage unpre apost ellos insist inspire unhappy imported carriage misunder
imagin crowds comed ranch lacking submar lanz obten downstairs puls deployed rude niveau desp talents raises editorial mandatory
synthetic gown harmon liberty prayers mise confusing leap arrives thats glimpse explored meantime raison existe lesser caution
limitation retour gewann miserable networking ottobre sede desen parc viagra overlap questioned permanently quella colleges
disappointment transitions seller febbra febbraio arom doctrine pear vault sedan heated reserves tobacco fragments booth cruise
noon terrified verification datasets miem uuid stern denom accidents packing whisk luego rectangle hooks neglect sober bapt lur
rested tastes confess diciembre absorption freeze calc surn functioning periodo patches convex uid schon masters lied aspir
breakdown designing confer partido interference absorbed deer graz feder unre siendo simpler hass mois activated internacional
enters logged expend brass melod attitudes owe bamb migrations polite luglio predecess maker implementing gev duplicate nonsense
ecc overl beautifully sniff incidents duck tek pilots traded inclined fierce theft gouvernement monaster approximate towel
siblings outrage mitt weed crops cnt austral slammed trailing appealing sung unos transm dignity facial bunk turno questioning
lear disadv mobility barriers aging farms costume mathematical nominated restoration unfortunate intact provoc fisher conting tops
artwork artillery cottage wherein tutorial sweep predomin commanded withdrawal seeks consulting critique circulation landsc herman
discour tolerance sticking slides cents ingen saddle champions shiny scrut olymp annually saint gleich perfection shorts justified
stripped ecosystem treats stance pity continually nightmare efect memcpy furono kindness competed oak disgu kings stuffed hilar
stressed loader reconstruction vod dun understands chaque prejud uso cuatro sidewalk united rugby financing comply rushing fen
presenting petit allerg worrying mamm operand realise assumes quand blessing eyebrows modeling greeted pedest aument speeds
syndrome astronom aprile gioc comport variance realizing estar sost rede toes advances newest phrases chr manufactured peint
upright mast debris grap prevention exotic eliminated navig renown foster realization miracle magnificent pci gir rand laying
encryption smelled suscept relaxation varieties gaps stole initialization goodness cope ignorance paras accidentally tand shipped
usize precip digging peas foul travels oktober memorable highlighted memo drawer priests hommes instructor spett sleeve strongest
inwon depressed arte combining pollution peripher italien repo pref earthqu hecho deserved supportive irrelevant ctrl nort comerc
corporation ripped anytime automated drawings enhancement wyn marvel pueden crashed denen blinked lion voce lob coastal sensors
illusion affecting compt profitable viable luminos affiliates ebenfalls corrected blues vendors customs activate blogs brace strat
tide aliment achievements suspicion touchdown mum denomin prevents shine clutch notably amely rodz klass destac frequencies
febrero stumbled prey medio cancellation libre wal explode limiting presumably memorial cuenta varies fluctuations warehouse
corrections fals controversy curse ignorant aesthetic vars socks imped neue dispers teens teenager loudly adventures mong diz
bitmap rebel radial assignments altre flies droit thickness enjo dwell homosexual eval philos veterans wildlife keywords
medications jamais ordin utilized severely libro puzzle alto ancora decomposition appetite comenz initiated sometime geometric
proceedings blacks sov custody ras tattoo recuper bem thou colony souvent apartments ano manifold coalition wheat strengths hey
plasma bob projet smoothly popped rott sotto gruppo instrumental practicing agrees denoted interviewed positioned overwhelmed
reprezent expects marijuana zaj begg nahm interrog shelves donne touches vale institutional ambitious nonetheless backpack
surroundings moisture wyd traders priorities pronounced expans energet lust surveys vista depicted occurring sandwich minut tunn
scarc trails depress resigned injection praised commissioned cinq summit curl visa resur absorb planets princess neuen ejempl
considers arrog hace contacted unple sponsored trainer fixing haber voll membres remarked releasing imports arqu imaginary
specialists hoof sadly leverage afin chopped dabei parti inaugur relaxing obey worries archae brushed structured homem navy sucked
zomb seas tense atm havet pierws tragic confidential consultant utilizing vintage membre tracing dej loops onclick stove gemeente
teaches fid nebo spel participant blond saves incluy ged empt alley travail recognised convicted mari pkt scandal individually
splitting sip fres groom canon abruptly afterward countryside fortunate buffers remot easiest invas clk blanc destroying filing
integrate slaughter longitud chunks unemployment slowed outlined ikke workspace kicking embedding analyzed favorites anderem honom
spoon jap vagy analytics sug peaks lawsuit disrupt nerves doubts sow aster conducting
""".split()
