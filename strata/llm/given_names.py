"""Given names that mark a person's name in text, by gender (fixed values).

Kept apart from the pool surrogates are drawn from and much larger. Names
that are mostly other words at the start of a sentence or places (Will, May,
June, Grant, Paris, Austin ...) are left out.
"""

FEMALE = """
Abigail Ada Adela Adele Adriana Agatha Agnes Aisha Alba Alejandra Alexandra Alexis Alice Alicia Alina Alison Allison
Alma Alyssa Amalia Amanda Amelia Amelie Amina Amy Ana Anastasia Andrea Angela Angelica Angelina Angelique Anita Anja
Anke Ann Anna Annabelle Anne Annette Annie Annika Antje Antoinette Antonia Ariana Ashley Astrid Audrey Aurelie Aurora
Ava Barbara Beatrice Beatriz Belinda Bernadette Bertha Beth Bethany Betty Beverly Bianca Birgit Blanca Bonnie Brenda
Brianna Bridget Brigitte Britta Brittany Camila Camille Candice Carla Carmen Carol Carole Carolina Caroline Carolyn
Cassandra Catalina Caterina Catherine Cathy Cecilia Celeste Celia Celine Chantal Charlene Charlotte Cheryl Chiara
Chloe Christa Christiane Christina Christine Cindy Claire Clara Claudia Clemence Colleen Concepcion Connie Consuelo
Corinne Cristina Crystal Cynthia Dagmar Daniela Danielle Daphne Deborah Debra Delphine Denise Diana Diane Dolores
Donna Dora Doris Dorothea Dorothy Edith Edna Eileen Elaine Eleanor Elena Eleonora Elisa Elisabeth Elise Eliza
Elizabeth Elke Ella Ellen Eloise Elsa Elsie Elvira Emilia Emilie Emily Emma Erica Erika Erin Esmeralda Esperanza
Estelle Esther Ethel Eugenia Eva Evelyn Fabienne Fatima Federica Felicia Fernanda Fiona Frances Francesca Francine
Francoise Franziska Frida Frieda Gabriela Gabriele Gabrielle Gail Genevieve Geraldine Gerda Germaine Gertrude
Gisela Giulia Gladys Glenda Gloria Grace Graciela Greta Gudrun Guadalupe Gwendolyn Hanna Hannah Harriet Hazel
Heather Heidi Heike Helen Helena Helene Helga Henrietta Hilda Hildegard Hortense Ida Ilse Imelda Ines Inge Ingeborg
Ingrid Inmaculada Irene Irina Iris Irma Irmgard Isabel Isabella Isabelle Jacqueline Jana Jane Janet Janice Janine
Jasmine Jeanne Jeannette Jennifer Jenny Jessica Jill Joan Joanna Joanne Jocelyn Johanna Josefa Josefina
Josephine Joyce Juana Juanita Judith Judy Julia Juliana Julie Juliet Juliette Karen Karin Karina Karla Katarina Kate
Katharina Katherine Kathleen Kathryn Kathy Katja Katrin Kayla Kelly Kerstin Khadija Kimberly Kirsten Kristen Kristin
Kristina Larissa Laura Lauren Laurence Lea Leah Leila Lena Leonie Leonor Leslie Leticia Lidia Lillian Linda Lisa
Lise Lorena Loretta Lori Lorraine Louise Lourdes Luciana Lucia Lucie Lucille Lucy Luisa Luise Luna Lydia Lynn
Mabel Madeleine Madeline Magdalena Manon Manuela Marcella Margaret Margarita Margarete Margaux Margot Marguerite
Maria Mariana Marianne Marie Marina Marion Marisa Marisol Marjorie Marlene Marta Martha Martina Martine Mary
Mathilde Matilda Maureen Maxine Megan Melanie Melinda Melissa Mercedes Meredith Michaela Michele Michelle Mildred
Millicent Mireille Miriam Molly Monica Monika Monique Montserrat Muriel Myriam Nadia Nadine Nancy Naomi Natalia
Natalie Nathalie Nicole Nicolette Nina Noemi Nora Norma Odette Odile Olga Olivia Ottilie Paloma Pamela Patrice
Patricia Paula Paulette Paulina Pauline Petra Philippa Phyllis Pilar Priscilla Rachel Ramona Raquel Rebecca Regina
Renate Renee Rita Roberta Rocio Rosa Rosalie Rosalind Rosario Rosemarie Rosemary Roxanne Ruth Sabine Sabrina Sally
Samantha Sandra Sara Sarah Saskia Sharon Sheila Shirley Silke Silvia Simone Sofia Solange Sonia Sonja Sophia Sophie
Soledad Stacy Stefanie Stella Stephanie Susan Susana Susanne Suzanne Svenja Sybille Sylvia Sylvie Tamara Tanja Tanya
Tatiana Teresa Theresa Therese Tiffany Tina Tracy Trudy Ulrike Ursula Uta Valentina Valeria Valerie Vanessa Vera
Veronica Veronika Veronique Victoria Viktoria Violeta Virginie Vivian Viviane Waltraud Wanda Wendy Wilhelmina
Wilma Ximena Yasmin Yolanda Yvette Yvonne Zoe
Adèle Agnès Amélie Anaïs Andrée Aurélie Béatrice Bénédicte Cécile Céline Chloé Clémence Concepción Désirée Élise
Éléonore Élodie Éloïse Émilie Estefanía Eugénie Françoise Geneviève Gisèle Hélène Inés Irène Jörgine Joséphine
Käthe Lucía Léa María Mélanie Noémie Océane Raphaëlle Renée Rocío Sofía Thérèse Valérie Verónica Véronique Zoé
Алина Алла Александра Анастасия Ангелина Анна Антонина Валентина Валерия Варвара Вера Вероника Виктория Галина Дарья
Евгения Екатерина Елена Елизавета Жанна Зинаида Зоя Инна Ирина Карина Кира Клавдия Кристина Ксения Лариса Лидия
Любовь Людмила Маргарита Марина Мария Надежда Наталья Нина Оксана Ольга Полина Раиса Светлана София Софья Тамара
Татьяна Юлия Яна
Άννα Αγγελική Αικατερίνη Αλεξάνδρα Αναστασία Βασιλική Γεωργία Δέσποινα Δήμητρα Ειρήνη Ελένη Ευαγγελία Ζωή Ιωάννα
Κατερίνα Κωνσταντίνα Μαρία Παναγιώτα Παρασκευή Σοφία Φωτεινή Χριστίνα
"""

MALE = """
Aaron Abdul Abdullah Abel Abraham Achim Adam Adolfo Adrian Adrien Ahmed Alan Alain Albert Alberto Albrecht Alejandro
Aleksander Alessandro Alex Alexander Alexandre Alexandros Alfonso Alfred Alfredo Ali Allan Allen Alois Alphonse Alvaro
Alvin Amir Anders Andre Andreas Andres Andrew Andy Angel Angelo Anselm Anthony Antoine Anton Antonio Armand Armando
Armin Arnaud Arnold Arthur Arturo Augustin Aurelien Axel Baptiste Barry Bartholomew Bastian Bastien Ben Benedict
Benedikt Benito Benjamin Benoit Bernard Bernardo Bernd Bernhard Bertrand Bill Billy Björn Bob Bobby Boris Brad
Bradley Brandon Brendan Brent Brian Bruce Bruno Bryan Burkhard Byron Calvin Cameron Carl Carlo Carlos Carsten Cecil
Cedric Cesar Charles Charlie Christian Christoph Christophe Christopher Clarence Claude Claudio Claus Clemens
Clement Clifford Clyde Colin Connor Conrad Cornelius Corey Craig Cristian Cristobal Curtis Cyril Dale Damian Damien
Dan Daniel Danny Dario Darren Darryl Dave David Dennis Denis Derek Detlef Didier Diego Dieter Dietmar Dietrich Dirk
Domingo Dominic Dominik Dominique Donald Douglas Duane Duncan Dustin Dwayne Dylan Earl Eberhard Eckhard Edgar
Edmond Edmund Eduard Eduardo Edward Edwin Egon Elias Elliot Emanuel Emil Emile Emiliano Emilio Emmanuel Enrico
Enrique Eric Erich Erik Ernest Ernesto Ernst Erwin Esteban Ethan Etienne Eugen Eugene Eugenio Evan Ewald Fabian
Fabien Fabio Fabrice Federico Felipe Felix Ferdinand Fernando Fidel Filip Florent Florian Floyd Francesco Francis
Francisco Franck Francois Frank Franklin Franz Fred Frederic Frederick Frederico Friedhelm Friedrich Fritz Gabriel
Gareth Gary Gaston Gavin Geoffrey George Georg Georges Gerald Gerard Gerardo Gerd Gerhard Gernot Gert Gilbert
Gilles Giovanni Giuseppe Glenn Godfrey Gonzalo Gordon Gottfried Graham Gregor Gregory Guido Guillaume Guillermo Gunter
Gustav Gustavo Hans Harald Harold Harry Hartmut Harvey Hassan Hector Heiko Heiner Heinrich Heinz Helmut Hendrik
Henri Henry Herbert Hermann Hernan Horacio Horst Howard Hubert Hugh Hugo Humberto Hussein Ian Ibrahim Ignacio Igor
Ingo Isaac Isaiah Ismael Ivan Jack Jacob Jacques Jaime Jakob James Jan Jared Jason Jean Javier Jeff Jeffrey Jeremy Jerome
Jerry Jesse Jesus Jim Jimmy Joachim Joaquin Jochen Joe Joel Johann Johannes John Johnny Jon Jonas Jonathan Jorge
Jose Josef Joseph Joshua Juan Juergen Jules Julian Julien Julio Julius Justin Karl Karsten Kaspar Keith Ken Kenneth
Kevin Klaus Konrad Konstantin Kurt Kyle Lance Lars Larry Laurent Lawrence Lee Leif Leo Leon Leonard Leonardo
Leonhard Leopold Leroy Lewis Liam Lloyd Logan Lorenz Lorenzo Lothar Louis Luc Luca Lucas Lucien Ludger Ludwig Luigi
Luis Lukas Luke Lutz Magnus Malcolm Manfred Manuel Marc Marcel Marcelo Marco Marcos Marcus Mario Marius Mark Marko
Markus Marlon Martin Marvin Mateo Mathias Mathieu Matthew Matthias Matthieu Maurice Mauricio Maurizio Max Maximilian
Maxime Melvin Michael Michel Miguel Mike Milton Mitchell Mohamed Mohammed Moritz Morris Muhammad Mustafa Nathan
Nathaniel Neil Nelson Niall Nicholas Nick Nicolas Niels Nigel Nikolai Nikolaus Niklas Noah Noel Norbert Norman Octavio
Olaf Oliver Olivier Omar Orlando Oscar Oskar Oswald Otto Owen Pablo Pascal Patricio Patrick Paul Pedro Percy Perry
Peter Phil Philip Philipp Philippe Phillip Pierre Rafael Rainer Ralf Ralph Ramiro Ramon Randall Randy Raphael Raul
Raymond Reginald Reiner Reinhard Reinhold Rene Ricardo Richard Rick Rob Robert Roberto Roderick Rodolfo Rodney Rodrigo
Roger Roland Rolando Rolf Roman Ronald Ronnie Ross Roy Ruben Rudi Rudolf Rupert Russell Ryan Salvador Salvatore
Sam Samuel Santiago Scott Sean Sebastian Sergio Seth Shane Shaun Shawn Siegfried Sigmund Simon Spencer Stanley Stefan
Stefano Stephan Stephane Stephen Steve Steven Stuart Sven Sylvain Ted Terence Terry Thaddeus Theo Theodor Theodore
Thibault Thierry Thomas Thorsten Till Tim Timothy Timo Tobias Todd Tom Tomas Tommy Tony Torsten Travis Trevor Tristan
Troy Tyler Udo Ulrich Uwe Valentin Vernon Vicente Victor Viktor Vincent Vincenzo Vladimir Volker Wade Wallace Walter
Warren Wayne Wendell Werner Wilbur Wilfried Wilhelm William Willy Winfried Winston Wolfgang Xavier Yannick Yusuf Yves
Zachary
Adrián Agustín Aurélien Álvaro Andrés André Benoît Cédric César Clément Désiré Édouard Émile Étienne Fabián Félix
Frédéric François Gaël Gérard Germán Götz Günter Günther Grégoire Héctor Hernán Iñigo Iván Jérôme Jérémy Jesús José
Joaquín Jörg Jürgen Jörn Julián Léon Loïc Martín Mathéo Matías Maël Nicolás Óscar Raphaël Rául Ramón Raúl René Rémi
Rémy Rubén Rüdiger Sébastien Stéphane Sören Thibaut Théo Théodore Tomás Víctor Wenzel
Адам Александр Алексей Анатолий Андрей Антон Аркадий Артём Богдан Борис Вадим Валентин Валерий Василий Виктор Виталий
Владимир Владислав Вячеслав Геннадий Георгий Глеб Григорий Даниил Денис Дмитрий Евгений Егор Иван Игорь Илья
Кирилл Константин Леонид Максим Марк Матвей Михаил Никита Николай Олег Павел Пётр Роман Руслан Сергей Станислав
Степан Тимофей Фёдор Юрий Яков Ярослав
Αθανάσιος Αλέξανδρος Αναστάσιος Ανδρέας Αντώνης Βασίλης Γεώργιος Γιάννης Γιώργος Δημήτρης Ευάγγελος Ηλίας Ιωάννης
Κωνσταντίνος Κώστας Μιχάλης Νίκος Νικόλαος Παναγιώτης Πέτρος Σπύρος Στέλιος Χρήστος
"""

GENDER = {n: "f" for n in FEMALE.split()} | {n: "m" for n in MALE.split()}

# Capitalised words that do not continue a name (function words at the start of
# a clause, days, months, kinds of places and bodies).
NOT_A_SURNAME = frozenset("""
A After All Also Although An And Are As At Be Because Before But By Can Could Did Do Does During For From Had Has Have
He Her His How However I If In Into Is It Its Not Of On Or Our She Should So Than That The Their Then There These They
This Those To Until Was We Were What When Where Which While Who Why Will With Would You Your
Und Oder Aber Der Die Das Den Dem Des Ein Eine Einen Einem Einer Er Sie Es Ist Sind War Wir Ihr Ich Nicht Mit Von Vor
Nach Bei Aus Auf Im Am Zum Zur Wenn Als Dann Denn Doch Auch
Et Ou Mais Le La Les Un Une Des Du De Il Elle Ils Elles Est Sont Nous Vous Je Ne Pas Avec Dans Pour Par Sur Si Que Qui
Y O Pero El Los Las Una Unos En Con Por Para Que Es Son Ella Ellos No Su Se
Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September
October November December Street Avenue Road Square University College School Hospital Airport Museum Church Inc Ltd
Corporation Company
""".split())
