"""Federation fixture: 12 CRM clients, 25 sales orders (two databases) and a
10-product CSV catalogue."""

# The data set whose results are to be matched, row by row.

CLIENTS = [
    ("C001", "Awa Diop", "Dakar", "77 123 45 67", "awa.diop@gmail.com", "2024-09-12"),
    ("C002", "Moussa Ndiaye", "Thies", "78 234 56 78", "moussa.ndiaye@yahoo.fr", "2024-10-03"),
    ("C003", "Fatou Sall", "Dakar", "76 345 67 89", "fatou.sall@gmail.com", "2024-11-21"),
    ("C004", "Cheikh Ba", "Dakar", "70 456 78 90", None, "2025-01-15"),
    ("C005", "Aissatou Diallo", "Saint-Louis", "75 567 89 01", "aissatou.diallo@hotmail.com", "2025-02-08"),
    ("C006", "Ibrahima Fall", "Kaolack", "77 678 90 12", "ibrahima.fall@gmail.com", "2025-03-19"),
    ("C007", "Ousmane Sarr", "Ziguinchor", "78 789 01 23", "ousmane.sarr@gmail.com", "2025-04-27"),
    ("C008", "Khady Gueye", "Dakar", "76 890 12 34", "khady.gueye@yahoo.fr", "2025-05-30"),
    ("C009", "Mamadou Sy", "Touba", "70 901 23 45", None, "2025-06-14"),
    ("C010", "Adama Kane", "Rufisque", "77 012 34 56", "adama.kane@gmail.com", "2025-07-22"),
    ("C011", "Bineta Mbaye", "Mbour", "75 123 45 67", "bineta.mbaye@gmail.com", "2025-08-09"),
    ("C012", "Serigne Diouf", "Louga", "78 210 43 65", "serigne.diouf@hotmail.com", "2025-09-05"),
]
CLIENT_COLS = ["client_id", "nom", "ville", "telephone", "email", "date_inscription"]

COMMANDES = [
    ("CMD01", "C001", "P001", 145000, "Orange Money", "livree", "2025-10-02"),
    ("CMD02", "C003", "P002", 25000, "Wave", "livree", "2025-10-05"),
    ("CMD03", "C002", "P010", 8500, "especes", "livree", "2025-10-07"),
    ("CMD04", "C001", "P003", 32000, "Orange Money", "livree", "2025-10-12"),
    ("CMD05", "C008", "P005", 57500, "carte", "livree", "2025-10-15"),
    ("CMD06", "C005", "P007", 12000, "Wave", "en_cours", "2025-10-18"),
    ("CMD07", "C004", "P008", 74500, "Orange Money", "livree", "2025-10-21"),
    ("CMD08", "C010", "P009", 15500, "Wave", "livree", "2025-10-24"),
    ("CMD09", "C006", "P006", 39000, "especes", "annulee", "2025-10-27"),
    ("CMD10", "C003", "P004", 28500, "Orange Money", "livree", "2025-11-01"),
    ("CMD11", "C009", "P010", 8500, "especes", "livree", "2025-11-04"),
    ("CMD12", "C012", "P008", 74500, "carte", "livree", "2025-11-08"),
    ("CMD13", "C001", "P002", 25000, "Wave", "livree", "2025-11-11"),
    ("CMD14", "C008", "P006", 39000, "Orange Money", "en_cours", "2025-11-14"),
    ("CMD15", "C999", "P004", 28500, "Wave", "livree", "2025-11-17"),
    ("CMD16", "C002", "P001", 145000, "Orange Money", "livree", "2025-11-20"),
    ("CMD17", "C005", "P007", 12000, "especes", "annulee", "2025-11-23"),
    ("CMD18", "C004", "P003", 32000, "Wave", "livree", "2025-11-26"),
    ("CMD19", "C010", "P001", 145000, "carte", "livree", "2025-11-29"),
    ("CMD20", "C006", "P010", 8500, "Orange Money", "livree", "2025-12-02"),
    ("CMD21", "C003", "P002", 25000, "Wave", "en_cours", "2025-12-05"),
    ("CMD22", "C009", "P005", 57500, "Orange Money", "livree", "2025-12-08"),
    ("CMD23", "C012", "P007", 12000, "especes", "livree", "2025-12-11"),
    ("CMD24", "C001", "P008", 74500, "carte", "livree", "2025-12-14"),
    ("CMD25", "C008", "P009", 15500, "Wave", "annulee", "2025-12-17"),
]
COMMANDE_COLS = ["commande_id", "client_id", "produit_id", "montant_fcfa", "moyen_paiement", "statut", "date_commande"]

PRODUITS_CSV = """produit_id,nom_produit,categorie,prix_fcfa,stock
P001,Smartphone Android,Electronique,145000,8
P002,Casque Bluetooth,Electronique,25000,15
P003,Sac en cuir,Mode,32000,6
P004,Robe wax,Mode,28500,12
P005,Montre connectee,Electronique,57500,0
P006,Chaussures sport,Mode,39000,10
P007,Batterie externe,Electronique,12000,20
P008,Boubou brode,Mode,74500,5
P009,Ecouteurs sans fil,Electronique,15500,18
P010,Ceinture cuir,Mode,8500,9
"""
