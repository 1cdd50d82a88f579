"""Identifier rules, accession patterns, prefixes and name tables. Order matters in every table."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    db_source: str
    species_hint: str
    source_hint: str
    assembly_hint: str
    pattern: str


def _rules(text: str) -> list[Rule]:
    return [Rule(*("" if part == "-" else part for part in line.split(None, 4))) for line in text.strip().splitlines()]


# The first rule whose pattern matches from the start of an identifier names its source. Case is ignored but for noncode.
ID_RULES = _rules(r"""
ncbi unknown_refseq refseq - ^(NM|NR|XM|XR|NP|XP|NG|NC|NT|NW|NZ)_\d+(\.\d+)?$
ensembl vertebrate ensembl - ^ENS[A-Z]*T\d{11}(\.\d+)?$
ucsc vertebrate ucsc - ^uc[0-9]{3}[a-z]{3}\.\d+$
wormbase caenorhabditis_elegans wormbase WBcel235 ^.*_wormbase:known_chromosome:WBcel\d+:
plant solanum_lycopersicum sgn SL4.0 ^Solyc\d+g\d+\.\d+\.\d+$
plant oryza_sativa rapdb_or_msu IRGSP-1.0/MSU7 ^OS\d+T\d+(?:_\d+)?(?:_cdna)?$
plant glycine_max phytozome Wm82 ^Glyma\.\d{2}G\d{6}(?:\.\d+)?$
plant arabidopsis_thaliana tair TAIR10 ^AT\dG\d+(?:\.\d+)?$
plant zea_mays ensembl_plants B73_RefGen_v4 ^Zm00001[de]\d+(?:_T\d+)?$
plant zea_mays maizegdb_or_ensembl B73 ^Zm\d+g\d+$
plant zea_mays maizegdb_legacy B73_v2_v3 ^GRMZM\w+
plant oryza_sativa msu_tigr MSU7 ^LOC_Os\d+g\d+
plant oryza_sativa rapdb IRGSP-1.0 ^Os\d+g\d+
plant triticum_aestivum ensembl_plants IWGSC ^TraesCS\w+\.\d+$
plant brachypodium_distachyon phytozome Bd21 ^Bradi[0-9]+g[0-9]+\.[0-9]$
plant brassica_rapa ensembl_plants - ^Bra\d+
plant brassica_napus ensembl_plants - ^BnaA\d+g\d+$
plant brassica_napus ensembl_plants - ^BnaC\d+g\d+$
plant brassica_oleracea ensembl_plants - ^Bo\dg\d+$
plant aegilops_tauschii ensembl_plants - ^AET\w+
plant amborella_trichopoda ensembl_plants - ^Amtr_\d+
plant amborella_trichopoda phytozome - ^evm_27\.model\.[A-Za-z0-9_.]+$
plant amborella_trichopoda ensembl_plants - ^evm\.model\.\w+\.\d+
plant chlamydomonas_reinhardtii phytozome - ^Cre\d+\.g\d+
plant physcomitrella_patens phytozome - ^Pp3c[0-9]+_[0-9]+V[0-9]+\.[0-9]$
plant physcomitrella_patens phytozome - ^Pp\d+s\d+_\d+
plant medicago_truncatula phytozome - ^Medtr\dg\d+
plant musa_acuminata ensembl_plants - ^GSMUA_\w+
plant oryza_brachyantha ensembl_plants - ^OB\d+g\d+
plant setaria_italica phytozome - ^Si\d+g\d+
plant theobroma_cacao phytozome - ^Thecc1EG\d+
plant citrus_sinensis citrusdb - ^orange1\.1g\d+
plant ricinus_communis tigr - ^\d{5}\.m\d{6}$
plant selaginella_moellendorffii phytozome - ^SM[0-9]+$
plant manihot_esculenta phytozome - ^Manes\.[0-9A-Z]+\.[0-9]$
plant manihot_esculenta cassava_db - ^cassava\d+\.\d+
plant zea_mays maizegdb_legacy B73_v2_v3 ^AC\d+\.\d+
plant populus_trichocarpa phytozome - ^Potri\.\d+G\d+$
plant sorghum_bicolor phytozome - ^Sobic\.[0-9A-Z]+\.[0-9]$
plant vitis_vinifera phytozome Genoscope.12X ^GSVIVT[0-9]+$
plant vitis_vinifera phytozome Genoscope.12X ^GTVIVG[0-9]+$
plant vitis_vinifera ensembl_plants - ^VIT_\d+s\d+$
plant solanum_tuberosum pgsc PGSC_DM_v3.4 ^PGSC\d+DM\w+
wormbase caenorhabditis_elegans wormbase WBcel235 ^[A-Z0-9]{1,3}\d+[A-Z]?\d*\.\d+[a-z]?(?:\.\d+)?$
flybase drosophila_melanogaster flybase dm6 ^FBtr\d+$
flybase drosophila_melanogaster flybase dm6 ^FBgn\d+$
wormbase caenorhabditis_elegans wormbase WBcel235 ^WBGene\d+$
sgd saccharomyces_cerevisiae sgd R64-1-1 ^Y[A-P][LR]\d+[WC](?:_[A-Z])?$
sgd saccharomyces_cerevisiae sgd R64-1-1 ^Q\d{4}$
sgd saccharomyces_cerevisiae sgd R64-1-1 ^Source:SGD;Acc:S\d+$
noncode unknown_noncode noncode - ^NON[A-Z]{3}T\d+\.\d+$
noncode unknown_noncode noncode - ^NON[A-Z]{3}G\d+\.\d+$
""")

# Where no rule holds, the first of these found anywhere in a header gives the identifier, its first group.
EMBEDDED_RULES = _rules(r"""
ncbi unknown_refseq refseq - (?:ref[\|_])?((?:NM|NR|XM|XR|NP|XP|NG|NC|NT|NW|NZ)_\d+(?:\.\d+)?)
plant zea_mays maizegdb_legacy B73_v2_v3 (GRMZM\w+)
plant brachypodium_distachyon phytozome Bd21 (Bradi[0-9]+g[0-9]+\.[0-9])
plant manihot_esculenta phytozome - (Manes\.[0-9A-Z]+\.[0-9])
plant sorghum_bicolor phytozome - (Sobic\.[0-9A-Z]+\.[0-9])
plant physcomitrella_patens phytozome - (Pp3c[0-9]+_[0-9]+V[0-9]+\.[0-9])
plant selaginella_moellendorffii phytozome - (SM[0-9]+)
plant vitis_vinifera phytozome Genoscope.12X (GSVIVT[0-9]+)
plant vitis_vinifera phytozome Genoscope.12X (GTVIVG[0-9]+)
plant solanum_tuberosum phytozome - (Stub[0-9]+g[0-9]+\.[0-9])
plant solanum_tuberosum pgsc PGSC_DM_v3.4 (PGSC\d+DM\w+)
plant citrus_sinensis citrusdb - (orange1\.1g\d+)
plant amborella_trichopoda phytozome - (evm_27\.model\.[A-Za-z0-9_.]+)
ensembl vertebrate ensembl - (ENS[A-Z]*T\d{11}(?:\.\d+)?)
ucsc vertebrate ucsc - (uc\d{3}[a-z]{3}\.\d+)
""")

# Accession families looked for anywhere in a header. Case is ignored but for the fifth.
ACCESSIONS = r"""
\b((?:NM|NR|XM|XR|NP|XP|NG|NC|NT|NW|NZ)_\d+(?:\.\d+)?)\b
\b(ENS[A-Z]*T\d{11}(?:\.\d+)?)\b
\b(ENS[A-Z]*G\d{11}(?:\.\d+)?)\b
\b(uc\d{3}[a-z]{3}\.\d+)\b
\b(NON[A-Z]{3}[TG]\d+\.\d+)\b
\b(AT[0-9CM]G\d{5}(?:\.\d+)?)\b
\b(Os\d{2}g\d{7})\b
\b(LOC_Os\d{2}g\d{5})\b
\b(Glyma\.\d{2}G\d{6}(?:\.\d+)?)\b
\b(Zm\d{5}g\d{6})\b
\b(GRMZM\w+)\b
\b(Solyc\d{2}g\d{6}\.\d+\.\d+)\b
\b(WBGene\d{8})\b
\b(FBtr\d{7})\b
\b(Y[A-P][LR]\d{3}[WC](?:_[A-Z])?)\b
""".split()
GI = r"(?i)gi[_|](\d+)[_|]ref[_|]((?:NM|NR|XM|XR|NP|XP|NG|NC|NT|NW|NZ)_\d+(?:\.\d+)?)[_|]?"

# The first prefix that an identifier starts with names its species.
PLANT_PREFIXES = {
    "AT": "arabidopsis_thaliana",
    "Os": "oryza_sativa",
    "LOC_Os": "oryza_sativa",
    "OS": "oryza_sativa",
    "Zm": "zea_mays",
    "GRMZM": "zea_mays",
    "AC": "zea_mays",
    "Solyc": "solanum_lycopersicum",
    "Glyma": "glycine_max",
    "PGSC": "solanum_tuberosum",
    "VIT_": "vitis_vinifera",
    "GSVIVT": "vitis_vinifera",
    "GTVIVG": "vitis_vinifera",
    "orange": "citrus_sinensis",
}
PHYTOZOME_PREFIXES = {
    "orange": "citrus_sinensis",
    "Sb": "sorghum_bicolor",
    "Sobic": "sorghum_bicolor",
    "PGSC": "solanum_tuberosum",
    "Glyma": "glycine_max",
    "Bradi": "brachypodium_distachyon",
    "Cre": "chlamydomonas_reinhardtii",
    "Pp": "physcomitrella_patens",
    "Medtr": "medicago_truncatula",
    "Si": "setaria_italica",
    "Thecc1EG": "theobroma_cacao",
    "Potri": "populus_trichocarpa",
    "VIT_": "vitis_vinifera",
    "GSVIVT": "vitis_vinifera",
    "GTVIVG": "vitis_vinifera",
}

# Assembly names, upper-cased without blanks, and their accessions.
GRC_ASSEMBLIES = {
    "GRCH38": "GCF_000001405.40",
    "GRCH37": "GCF_000001405.39",
    "GRCZ11": "GCF_000002035.6",
    "GRCZ10": "GCF_000002035.5",
    "GRCRH1": "GCF_000008735.2",
    "GRCM39": "GCF_000001635.27",
    "GRCM38": "GCF_000001635.26",
    "GRCH13": "GCF_000004545.3",
    "BDGP6": "GCF_000001215.4",
    "BDGP5": "GCF_000001215.3",
    "BDGP6_32": "GCF_000001215.4",
    "ARS-UCD2.0": "GCF_002263795.2",
}
GRC_NAMES = {"GRCH38": "GRCh38", "GRCH37": "GRCh37", "GRCZ11": "GRCz11", "GRCZ10": "GRCz10", "GRCM39": "GRCm39", "GRCM38": "GRCm38", "ARS-UCD2.0": "ARS-UCD2.0"}
UCSC_ASSEMBLIES = {
    "TAIR10": "GCF_000001735.4",
    "CE10": "GCF_000002985.6",
    "DM6": "GCF_000001215.4",
    "RN6": "GCF_000001895.5",
    "MONDOM5": "GCF_000002295.2",
    "PONABE2": "GCF_000001545.5",
    "GALGAL4": "GCF_000002315.6",
    "ORNANA1": "GCF_000002275.2",
    "BOSTAU6": "GCF_000003055.6",
    "DANRER10": "GCF_000002035.6",
}
UCSC_ASSEMBLIES_MORE = UCSC_ASSEMBLIES | {"DANRER7": "GCF_000002035.5", "DM3": "GCF_000001215.3", "GALGAL3": "GCF_000002315.5"}
# The chromosomes of an assembly whose lookup fails.
CHROMOSOME_ASSEMBLIES = dict.fromkeys(
    "NC_008394.4 NC_008395.2 NC_008396.2 NC_008397.2 NC_008398.2 NC_008399.2 NC_008400.2 NC_008401.2 NC_008402.2 NC_008403.2 NC_008404.2 NC_008405.2 NC_011033.1 NC_001320.1 NC_001751.1".split(),
    "GCF_000005425.2",
)
CHROMOSOME_PREFIXES = ("NC_", "NT_", "NW_", "AC_")

# What a log says of a failure, the most telling first, and how it is told; None: as it stands.
LOG_FAILURES = (
    (r"Permanent failure \(HTTP (\d+)\)[^\n]*not retrying[^\n]*", "HTTP {1} — not retrying"),
    (r"Permanent failure \(HTTP (\d+)\)", "HTTP {1} permanent error"),
    (r"HTTP (\d{3})", "HTTP {1} error"),
    (r"Decompression failed: ([^\n]+)", "decompression failed: {1}"),
    (r"FAILED \(exit (\d+)\): ([^\n]+)", "samtools exit {1}: {2}"),
    (r"Could not determine [^\n]+URL[^\n]*", None),
    (r"FTP directory listing[^\n]*contained no matching folder", None),
    (r"All download attempts failed", None),
    (r"log unreadable", None),
)

# Cells that stand for a missing value.
NULL_TOKENS = ("", "nan", "none")
CSV_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Noncode prefixes (without the last letter, T or G) by release: organism and assembly, and the file's name of the species.
NONCODE_V5 = {
    "NONDME": ("Drosophila melanogaster", "dm6", "fruitfly"),
    "NONCEL": ("Caenorhabditis elegans", "ce10", "celegans"),
    "NONDRE": ("Danio rerio", "danRer10", "zebrafish"),
    "NONGGA": ("Gallus gallus", "galGal4", "chicken"),
    "NONMDO": ("Monodelphis domestica", "monDom5", "opossum"),
    "NONOAN": ("Ornithorhynchus anatinus", "ornAna1", "platypus"),
    "NONPPY": ("Pongo abelii", "ponAbe2", "orangutan"),
    "NONRAT": ("Rattus norvegicus", "rn6", "rat"),
    "NONATH": ("Arabidopsis thaliana", "tair10", "arabidopsis"),
    "NONBTA": ("Bos taurus", "bosTau6", "cow"),
    "NONHSA": ("Homo sapiens", "hg38", "human"),
    "NONMMU": ("Mus musculus", "mm10", "mouse"),
    "NONPTR": ("Pan troglodytes", "panTro4", "chimp"),
    "NONGGO": ("Gorilla gorilla", "gorGor3", "gorilla"),
    "NONGRO": ("Gorilla gorilla", "gorGor3", "gorilla"),
    "NONMML": ("Macaca mulatta", "rheMac3", "rhesus"),
    "NONSSC": ("Sus scrofa", "susScr3", "pig"),
}
NONCODE_ABSENT = ("NONGGOG", "NONGROT")
NONCODE_V4 = {
    "NONCEL": ("Caenorhabditis elegans", "ce10"),
    "NONDME": ("Drosophila melanogaster", "dm3"),
    "NONDRE": ("Danio rerio", "danRer7"),
    "NONGGA": ("Gallus gallus", "galGal3"),
    "NONBTA": ("Bos taurus", "bosTau6"),
    "NONHSA": ("Homo sapiens", "hg19"),
    "NONMMU": ("Mus musculus", "mm9"),
}

# Places spelt out in headers and identifiers, and the names of each pattern's groups.
WORMBASE_PLACE = (r"(?i)^([^_]+)_wormbase:known_chromosome:(WBcel\d+):([^:]+):(\d+):(\d+):.*gene:(WBGene\d+)", ("gene_symbol", "assembly_accession", "chrom", "start", "end", "gene_id"))
TAIR_PLACE = (r"(?i)chromosome:(TAIR10):([^:]+):(\d+):(\d+):([-+_]?1)\s+gene:(AT\dG\d+)", ("assembly_accession", "chrom", "start", "end", "strand", "gene_id"))
FLYBASE_PLACE = (r"(?i)chromosome:([^:]+):([^:]+):(\d+):(\d+):([-+_]?1)\s+gene:(FBgn\d+).*?gene_symbol:([^\s]+)", ("assembly_accession", "chrom", "start", "end", "strand", "gene_id", "gene_symbol"))

# The features of a yeast annotation that stand for genes.
YEAST_FEATURES = ("gene", "pseudogene", "transposable_element_gene", "blocked_reading_frame", "long_terminal_repeat")

# Prefix, species and build of Ensembl transcripts. Prefixes that end in a digit or in G are left out: no transcript's prefix does.
ENSEMBL_PREFIXES = [tuple(line.split(None, 2)) for line in """
ENST homo_sapiens GRCh38
ENSPTRT pan_troglodytes Pan_tro_3.0
ENSPANT pan_paniscus panpan1.1
ENSGGOT gorilla_gorilla gorGor4
ENSPPYT pongo_abelii Susie_PABv2
ENSNLET nomascus_leucogenys Nleu_3.0
ENSMICT microcebus_murinus Mmur_3.0
ENSOGAT otolemur_garnettii OtoGar3
ENSCJAT callithrix_jacchus mCalJac1.pat.X
ENSMMUT macaca_mulatta Mmul_10
ENSMFAT macaca_fascicularis Macaca_fascicularis_6.0
ENSANOT aotus_nancymaae Anan_2.0
ENSSBOT saimiri_boliviensis_boliviensis SaiBol1.0
ENSCCET cebus_imitator Cebus_imitator-1.0
ENSCSAT chlorocebus_sabaeus ChlSab1.1
ENSPHAT papio_anubis Panubis1.0
ENSTSYT theropithecus_gelada Tgel_1.0
ENSMNET mandrillus_leucophaeus Mleu.le_1.0
ENSCATT colobus_angolensis_palliatus Cang.pa_1.0
ENSPINGT piliocolobus_tephrosceles ASM277652v2
ENSREXT rhinopithecus_roxellana Rrox_v1
ENSNASAT nasalis_larvatus ASM242139v1
ENSMUST mus_musculus GRCm39
ENSMSPRT mus_spretus SPRET_EiJ_v1
ENSMPAHT mus_pahari PAHARI_EiJ_v1
ENSMCART mus_caroli CAROLI_EiJ_v1
ENSRNOT rattus_norvegicus mRatBN7.2
ENSCPOT cavia_porcellus Cavpor3.0
ENSOCUNT octodon_degus OctDeg1.0
ENSCAST castor_canadensis C.can_genome_v1.0
ENSDORT dipodomys_ordii Dord_2.0
ENSPEMOT peromyscus_maniculatus_bairdii HU_Pman_2.1
ENSMOCET microtus_ochrogaster MicOch1.0
ENSNFORT nannospalax_galili S.galili_v1.0
ENSMAVGT marmota_marmota_marmota marMar2.1
ENSUAMGT urocitellus_parryii ASM342692v1
ENSICGT ictidomys_tridecemlineatus SpeTri2.0
ENSFCDT fukomys_damarensis DMR_v1.0
ENSHETGT heterocephalus_glaber_female HetGla_female_1.0
ENSOHANT ochotona_princeps OchPri3.0
ENSCAFT canis_lupus_familiaris ROS_Cfam_1.0
ENSVVUT vulpes_vulpes VulVul2.2
ENSMPET mustela_putorius_furo MusPutFur1.0
ENSNVIT neovison_vison NNQGG.v01
ENSAMET ailuropoda_melanoleuca ASM200744v2
ENSUPMT ursus_maritimus UrsMar_1.0
ENSUPAT ursus_americanus ASM334442v1
ENSFCAT felis_catus Felis_catus_9.0
ENSPLOT puma_concolor PumCon1.0
ENSLPAT lynx_pardinus mLynPar1.p
ENSTTRT trichechus_manatus_latirostris TriManLat1.0
ENSLABT loxodonta_africana loxAfr3
ENSPVAT procavia_capensis proCap1
ENSOGAST orycteropus_afer_afer OryAfe1.0
ENSDDST dasypus_novemcinctus Dasnov3.0
ENSCHOET choloepus_hoffmanni choHof1
ENSBTRT bos_taurus ARS-UCD1.3
ENSBGRT bos_grunniens LU_Bosgru_v3.0
ENSOGLT ovis_aries_rambouillet Oar_rambouillet_v1.0
ENSCCHT capra_hircus ARS1
ENSSSCRT sus_scrofa Sscrofa11.1
ENSWAFT vicugna_pacos vicPac1
ENSLCAT lama_glama mLamGla1.p
ENSECBT equus_caballus EquCab3.0
ENSEAFT equus_asinus ASM1607732v2
ENSCDRT camelus_dromedarius CamDro3
ENSDNOT delphinapterus_leucas ASM228892v3
ENSOORT orcinus_orca Oorc_1.1
ENSLHKT lipotes_vexillifer Lipotes_vexillifer_v1
ENSSHRT sorex_araneus SorAra2.0
ENSCPUT condylura_cristata ConCri1.0
ENSTOGT tupaia_belangeri TREESHREW 1.0
ENSRTPT rhinolophus_ferrumequinum mRhiFer1_v1.p
ENSMYLT myotis_lucifugus Myoluc2.0
ENSMVIT miniopterus_natalensis MiniNat1.0
ENSETST erinaceus_europaeus eriEur1
ENSSGAT sarcophilus_harrisii mSarHar1.11
ENSSHAWT monodelphis_domestica monDom5
ENSMEUGAT macropus_eugenii Meug_1.0
ENSOANT ornithorhynchus_anatinus mOrnAna1.p.v1
ENSGALT gallus_gallus bGalGal1.mat.broiler.GRCg7b
ENSMGALT meleagris_gallopavo Turkey_5.1
ENSAMPT anas_platyrhynchos CAU_duck1.0
ENSAACT aquila_chrysaetos_chrysaetos bAquChr1.2
ENSFALT ficedula_albicollis FicAlb1.5
ENSGMOT geospiza_fortis GeoFor1.0
ENSTGUT taeniopygia_guttata bTaeGut2.pat.W
ENSPCAT pseudopodoces_humilis PseHum1.0
ENSMLEUT manacus_vitellinus ManVit1.0
ENSFHETT falco_tinnunculus bFalTin1.pri
ENSACOT antrostomus_carolinensis ASM69998v1
ENSANCT anolis_carolinensis AnoCar2.0
ENSPSVT pogona_vitticeps pVitVit3.0
ENSCRCT crocodylus_porosus CroPor_comp1
ENSGGAT gopherus_agassizii ASM289641v1
ENSCMYT chelonia_mydas CheMyd1.0
ENSPMYT pelodiscus_sinensis PelSin1.0
ENSPTYT python_bivittatus Python_molurus_bivittatus-5.0.2
ENSXETT xenopus_tropicalis UCB_Xtro_10.0
ENSDART danio_rerio GRCz11
ENSGMORT gasterosteus_aculeatus BROADS1
ENSORLT oryzias_latipes ASM223467v1
ENSONIT oreochromis_niloticus O_niloticus_UMD_NMBU
ENSAMXT astyanax_mexicanus Astyanax_mexicanus-2.0
ENSPOCT poecilia_reticulata Guppy_female_1.0_MT
ENSPFOT poecilia_formosa Poecilia_formosa-5.1.2
ENSSART sparus_aurata fSpaAur1.1
ENSSFAT scophthalmus_maximus fScoMax1.pri
ENSXMAT xiphophorus_maculatus X_maculatus-5.0-male
ENSLCALT lates_calcarifer ASB_HGAfBa0_CSIRO
ENSNOBT nothobranchius_furzeri Nfu_20140520
ENSECALT eptatretus_burgeri Eburgeri_3.2
ENSPMAT petromyzon_marinus Pmarinus_7.0
ENSCALT callorhinchus_milii Callorhinchus_milii-6.1.3
ENSPSIT protopterus_annectens ProtAnn1.0
ENSLOCT lepisosteus_oculatus LepOcu1
ENSCCAT cyprinus_carpio common_carp_genome
ENSICPT ictalurus_punctatus IpCoco_1.2
ENSASIT astatotilapia_calliptera fAstCal1.2
ENSOKAT oncorhynchus_kisutch Okis_V2
ENSOMT oncorhynchus_mykiss Omyk_1.0
ENSSSAT salmo_salar Ssal_v3.1
ENSCLACT clupea_harengus Ch_v2.0.2
ENSMZET maylandia_zebra M_zebra_UMD2a
ENSHCULT haplochromis_burtoni AstBur1.0
ENSTRUPT takifugu_rubripes fTakRub1.2
ENSTNIGET tetraodon_nigroviridis TETRAODON 8.0
ENSOULT oryzias_melastigma Om_v0.7.RACA
ENSCSAVT ciona_savignyi CSAV 2.0
ENSCINTT ciona_intestinalis KH
""".strip().splitlines()]
