"""Labelled line sequences that the line model learns from: ``+`` marks content, ``-`` boilerplate."""

SEQUENCES = (
    """
+ The ship left the harbour before dawn, and the crew had little time to rest. Nobody spoke of the storm.
+ By noon the wind had turned.
+ They reached the island two days later, when the last of the bread was gone and the water tasted of iron.
- Released under the MIT License.
""",
    """
- Home | About | Contact | Products | Careers | Press
- Log in | Register | Help
+ Our town has three bridges, of which the oldest was built by monks. It still carries carts and, on Sundays, a market.
+ The second one is younger.
- Copyright 2019. All rights reserved.
""",
    """
+ Der alte Garten lag hinter dem Haus, und im Sommer roch es dort nach Minze. Niemand wusste, wer ihn angelegt hatte.
+ Im Herbst kam der Nachbar, um die Bäume zu schneiden.
+ Dann wurde es still.
- Veröffentlicht unter der Apache License, Version 2.0.
""",
    """
- BUY NOW!! BEST!! PRICES!! IN!! TOWN!!
- ONLY!! TODAY!! HURRY!! UP,!! FRIENDS.!! CALL!! US!!
- DEALS!! DEALS!! EVERY!! DAY!! NEW!! DEALS!! THE!! BEST!! FOR!! YOU.
""",
    """
+ A short note about the bridge.
- OFFERS!! OF!! THE!! DAY!! ARE!! HERE!! COME!! AND!! SEE,!! SHOPS!! OPEN!! LATE!!
- GREAT!! CHEAP!! FLIGHTS!! TO!! ALL!! PLACES!! BOOK!! THEM.
- LAST!! CHANCE!! FOR!! ALL!! OF!! YOU.
""",
    """
- the*** best$$$ offers### today%%% only*** for$$$ you### and%%% yours*** here$$$
- winner### of%%% the*** day,$$$ the### price%%% is*** yours.$$$ Come### in%%%
- cheap&&& tickets*** to%%% the### show.$$$
""",
    """
+ A list of what was found follows.
- amount*** total$$$ paid%%% by&&& card### on*** friday$$$ in&&& town%%% again.
- name&&& street*** city%%% code$$$ phone### mail*** web.
""",
    """
- apples | pears | plums | cherries | grapes | figs.
- red | green | blue | yellow | white | black
- one | two | three | four | five | six | seven | eight.
- north | south | east | west
""",
    """
+ Le vieux port dormait encore, mais les pêcheurs étaient déjà partis. La mer était calme, presque grise.
+ Vers midi, le vent se leva et les voiles revinrent une à une.
+ On entendait les enfants.
- Tous droits réservés. Mentions légales. Conditions d'utilisation.
""",
    """
+ El camino sube entre pinos, y al final hay una casa blanca. Desde allí se ve todo el valle, hasta el río.
+ Nadie vive en ella desde hace años.
- Inicio | Noticias | Contacto | Aviso legal
""",
    """
- spam spam spam spam spam spam spam spam eggs eggs eggs eggs eggs eggs
- buy buy buy buy buy buy buy buy buy now now now now now now
- more more more more more more more
""",
    """
- go go go go go go go go go go go go stop. stop. stop. stop. stop. stop. stop.
""",
    """
- We use cookies to improve your experience. By continuing you accept our cookie policy.
- Accept all cookies
+ When the committee met again in March, it had two reports before it. The first, written by engineers, was short.
+ The second was not, and few had read it to the end before they were asked to vote on what it proposed.
+ It was adopted all the same.
- Subscribe to our newsletter
- Share on social media
- Read more
""",
    """
+ She opened the letter. It was from her brother, who had moved to the coast.
+ He wrote that he had found work in a mill and a room above a bakery.
+ "Come and see," it ended.
+ She did, in June.
""",
    """
+ Yes.
+ The answer surprised all of them, although it had been in the file from the beginning, on the last page.
+ No.
+ They read the file once more, slowly, and then put it back where it had come from, since nothing else was left to do.
""",
    """
+ Water boils at a lower temperature in the mountains, because the air is thinner there. Cooks learn it quickly.
+ Beans take an hour more.
+ Bread, too, behaves differently: it rises faster and dries out sooner, so bakers use less yeast.
- Copyright (c) 2021 The Authors. Licensed under the Apache License, Version 2.0.
- https://example.org/licenses https://example.org/terms
""",
    """
- 2019-01-03 12:00:01 404 1881 0 17
- 2019-01-03 12:00:04 200 9120 0 22
- 2019-01-03 12:00:09 200 9120 0 21
- 2019-01-03 12:00:11 500 12 3 19
""",
    """
+ The archive opens at nine. Visitors leave their coats and bags at the door, take a number, and wait.
- PLEASE!! DO!! NOT!! FORGET!! YOUR!! CARD,!! FRIENDS!! AND!! GUESTS!!
+ Maps are kept on the second floor, in flat drawers, and must not be folded. Copies can be ordered at the desk.
+ At noon a bell is rung, and the reading room stays empty for an hour.
""",
    """
+ The river had two names, one for each bank. In spring it took the meadows, and in autumn it gave them back.
+ The river had two names, one for each bank. In spring it took the meadows, and in autumn it gave them back.
- Terms of use | Privacy | Imprint
- Terms of use | Privacy | Imprint
""",
)
