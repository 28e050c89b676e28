"""Thirty reviewed messages with their true class, routing, reply and human scores."""

# One abusive word is masked; no rule looks at it.
# (message, intent, routing, reply, (correctness, helpfulness, brand tone, groundedness))
REVIEWED = [
    ("iPhone 7, 11.1. the phone doesn't seem to be charging half the time when it's plugged in.",
     'charging_issue', 'AUTO',
     "We know how important it is to be able to charge your iPhone, and we want to help. Let's start by trying the steps here: Please let us know if you're still having trouble charging.", (5, 5, 5, 5)),
    ('I cant even write a word without the app lagging and crashing. The keyboard keeps lagging as well ,my phone got worse with this new update',
     'software_update', 'AUTO',
     "We don't like to hear you're not able to use Messages. What iOS version do you have? See Settings > General > About", (4, 4, 5, 5)),
    ('My airpods were working fine yesterday and then when i went to go listen to music on then today there was no light on the inside of the case and they didn t connect to my phone I ve had these for just over 1 month',
     'device_setup', 'AUTO',
     'Thanks for reaching out to us for support. We would love to help you. Please DM us so that we can look into this together.', (5, 4, 5, 5)),
    ('hey I am getting issues with iOS 11.0.1 can t share pdf, battery is getting drained very fast',
     'battery_issue', 'AUTO',
     "We'd like to gather some more information for better troubleshooting. Can you DM us the country you are located in?", (5, 5, 4, 5)),
    ("How my phone dying while it's on the charger???",
     'charging_issue', 'AUTO',
     "That's certainly not what we would expect. We'll be happy to assist as best we can. When did this start happening?", (4, 4, 5, 4)),
    ('How do I get a refund on the iCloud? It says I can get a refund within 15 days.',
     'billing_refund', 'ESCALATE',
     'Hi there! Our iTunes Store team would be happy to look into this with you. Reach out to them here:', (5, 5, 5, 5)),
    ('Soo .. Wassup with this update? The app store doesn t work correctly and it keeps asking me to sign over, and over, and over.. well .. you get it..fix it please .. thank you .. This 8 Plus costs too much to be having these issues',
     'app_store', 'AUTO',
     "We'd be happy to assist with your App Store today. Send us a DM to get started.", (5, 4, 5, 5)),
    ("Completely locked out. I can remember my username and password. I can't remember the answers I gave to these security questions. Locked out and sent back to start with only 'forgot password' option. Total road block. Total loss of user control over my ID.",
     'apple_id_login', 'AUTO',
     "We'd like to help. Let's take this to DM and we'll explore ways to provide you assistance.", (4, 4, 4, 5)),
    ('where is the "show as busy" setting in MacOS Sierra\'s calendar?',
     'software_update', 'AUTO',
     'Great question. When you create a new event, you sill see the option when clicking on the date or time.', (5, 5, 5, 5)),
    ('why is my iPhone 8 Plus battery literally lasting like 3 hours?',
     'battery_issue', 'AUTO',
     "We'd be happy to assist with your battery today. Send us a DM to get started.", (5, 5, 5, 5)),
    ('TestFlight crashing like a hell on iPad running iOS 11',
     'app_store', 'AUTO',
     "We're here to help. Are you using iOS 11.0.3? You can verifiy this in Settings > General > About. Go ahead and DM us.", (4, 4, 5, 4)),
    ('I have the 6s and everything went downhill when I downloaded iOS 11',
     'software_update', 'AUTO',
     'We definitely want to help here. Give us more detail about when you see the battery depleting the most.', (5, 5, 4, 5)),
    ('I love that since I updated to the new iOS that my battery lasts an like an hour. Especially after replacing the battery weeks ago',
     'battery_issue', 'AUTO',
     "We'd be happy to look into this with you. Could you please send us a DM so we can gather some info?", (5, 4, 5, 5)),
    ('I still have to enter my password for the App Store when I have Face ID on my iPhone X?! Thought my face was my password ?!',
     'app_store', 'AUTO',
     "We'd be glad to look into this with you. Does this happen with every download? Let us know in DM to get started.", (5, 5, 5, 5)),
    ('How do I go back to iOS 10 on my iphone? 11 is terrible! Phone keeps resetting.....',
     'software_update', 'AUTO',
     'Thanks for reaching out to us. Going back to iOS 10 is not supported. Send us a DM so we can look into your issues together.', (4, 4, 5, 4)),
    ('Why isn t it possible to change the e-mail adress from my AppleID? Was created with gmail, now i want only icloud.',
     'apple_id_login', 'AUTO',
     "We know how important your Apple ID is and we'd like to help. Please take a look at this article:", (5, 5, 4, 5)),
    ('So that will make a iCloud back up',
     'icloud_sync', 'AUTO',
     "When you back up your iPhone to iCloud or iTunes, your iPhone backup will also include your Apple Watch data. Here's how to back up your iPhone with iCloud:", (4, 4, 5, 5)),
    ('do or any math majors or anybody wanna help me understand and explain what the **** going on with my storage? is everything a scam? can we not get played for once? do a **** need to get a galaxy? like what the **** going on!',
     'account_security', 'ESCALATE',
     "We'd be happy to look into your storage space with you. Send us a DM to get started.", (5, 4, 5, 5)),
    ('The App Store not letting me download any apps',
     'app_store', 'AUTO',
     'Thanks for reaching out. DM which iPhone and specific iOS version you are using so we can help.', (5, 5, 5, 5)),
    ('Anyone else s iPhone Alarm app crash everytime they try set an alarm!? #howdoiwakeupforwork',
     'app_store', 'AUTO',
     'That should not be happening. Let us help. Which iOS version are you using? You can check in Settings > General > About.', (4, 4, 4, 4)),
    ('how can 11mins of safari use 40% of my battery? iPhone 7 iOS 11.1',
     'battery_issue', 'AUTO',
     "Hey, we'd like to gather some more details. Send us a DM and we'll work together from there.", (5, 5, 5, 5)),
    ('I became a beta tester and some of the apps I rely on the most are buggy. Can you restore old iOS versions without using an old iCloud backup?',
     'icloud_sync', 'AUTO',
     'Absolutely, you can restore to the most recent public version of iOS. It requires you to restore the phone to factory settings and set it up as new though. Would you like us to assist you with that? If so, send us a DM.', (5, 4, 5, 5)),
    ('- reporting a facebook bug witl ios 11! The application close by it self!',
     'software_update', 'AUTO',
     'Thank you for reaching out to us! Are you seeing this issue with any other apps at all or just the Facebook app?', (4, 4, 4, 5)),
    ('T-Mobile could activate the cellular service due to the esim being linked to another number. I am just so furious. How can I get a used one?',
     'device_setup', 'AUTO',
     "We're happy to look into this situation for you. Join us in DM to get started:", (5, 5, 5, 5)),
    ('me too. lost all my imessages too. my icloud backups all deleted too',
     'icloud_sync', 'ESCALATE',
     "Let's help take a closer look in recovering that content. Please DM us and we can go from there.", (5, 5, 5, 5)),
    ('I m still unable to change my Apple ID from to I want to use my alias address',
     'apple_id_login', 'AUTO',
     "We want to help out. Let's take a look here:", (4, 4, 5, 4)),
    ("Hello, I'm planning to buy Iphone X from apple store and i have a trip to Europe - Bulgaria. There is a One-time payment option which says Unlocked iPhone with Sprint SIM for 999. Will I be able to use the phone with Telenor sim?",
     'billing_refund', 'ESCALATE',
     "Hi there. We've received your DM. We will follow up with you there shortly.", (5, 5, 4, 5)),
    ('where is MY DELIVERY??? SCAM! Letting know ur CO scams them as well. No delivery. Will cx order with Apple BC of You!',
     'account_security', 'ESCALATE',
     'Thanks for reaching out. For issues with an order, connect with our Apple Online Store support here:', (5, 4, 5, 5)),
    ('I m having serious issues with iCloud notes. A critical note of mine is showing up as an ancient version of it. And to further confuse things, it s one older version on and a different older version on my phone, but neither are correct.',
     'icloud_sync', 'AUTO',
     'Thanks for reaching out. We know how important your notes are. We want to help. Are you signed into the same Apple ID? If you go to on a computer, do you see the current version of the note?', (4, 4, 5, 4)),
    ('please fix iOS 11 already. I have an 8 Plus and the performance is just ridiculous',
     'software_update', 'AUTO',
     'We want to help. What specifically is going on with your 8 Plus?', (5, 5, 4, 5)),
]
